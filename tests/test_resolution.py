"""Companies against a brute-force walk over the rows."""

import random
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pytest

from scrapeloom.operators import resolution

COLUMNS = (
    "row_no long, company_name string, phone_clean string, website_clean string, "
    "category string, scrape_date string"
)


def rows(seed, n, hot=False):
    rng = random.Random(seed)
    names = ["Acme Legal", "acme legall", "ACME  Legal!", "Borealis Cloud", "Borealis Clouds", "Zeta", None, "!!!"]
    out = []
    for i in range(n):
        phone = rng.choice([None, None, "2000000001", "2000000002", "2000000003"])
        site = rng.choice([None, None, "https://www.a.io/x", "a.io", "http://b.io:80", "https://"])
        if hot and i % 3 == 0:
            phone, site = "2000000001", "a.io"
        out.append(
            (
                i, rng.choice(names), phone, site, rng.choice(["ERP", "HR", "Unknown", None]),
                rng.choice([None, "2026-06-03", "2026-06-01", "2026-6-1"]),
            )
        )
    return out


def host(site):
    bare = (site or "").split("://")[-1].removeprefix("www.").split("/")[0].split(":")[0]
    return bare or None


def plain(name):
    kept = "".join(c for c in (name or "").lower().strip() if c.isalnum() or c in "_ ")
    return " ".join(kept.split())


def brute_force(data, nameless="merge"):
    """Golden record per company, with the tier and the rows in it."""
    groups, leaders = defaultdict(list), []
    for r in data:
        no, name, phone, site = r[:4]
        if phone:
            key = (1, phone)
        elif host(site):
            key = (2, host(site))
        elif nameless == "singleton" and not plain(name):
            key = (3, f"row {no}")
        else:
            n = plain(name)
            lead = next((x for x in leaders if SequenceMatcher(None, n, x).ratio() >= 0.9), None)
            if lead is None:
                leaders.append(n)
                lead = n
            key = (3, lead)
        groups[key].append(r)

    def mode(values):
        counts = Counter(v for v in values if v is not None)
        return min(counts, key=lambda v: (-counts[v], v)) if counts else None

    return [
        (
            key[0],
            mode(r[1] for r in group),
            mode(r[2] for r in group),
            "|".join(sorted({r[4] for r in group if r[4]})),
            len(group),
            min((r[5] for r in group if r[5]), default=None),
            len({r[2] for r in group if r[2]}),
            len({host(r[3]) for r in group if host(r[3])}),
            len({r[1] for r in group if r[1] is not None}),
        )
        for key, group in groups.items()
    ]


FIELDS = (
    "tier", "canonical_name", "canonical_phone", "categories", "n_raw_rows", "first_seen",
    "unique_phones", "unique_domains", "unique_names",
)


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("nameless", ["merge", "singleton"])
@pytest.mark.parametrize("hot", [False, True])
def test_entities_equal_brute_force(spark, nameless, hot):
    data = rows(11, 240, hot)
    clean = spark.createDataFrame(data, COLUMNS)
    found = resolution.resolve(clean, ["row_no"], nameless=nameless)
    got = [tuple(r) for r in found.entities.select(*FIELDS).collect()]
    assert sorted(got, key=key) == sorted(brute_force(data, nameless), key=key)
    ids = sorted(r[0] for r in found.entity_map.select("entity_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    # ids follow the tiers
    tiers = [r[0] for r in found.entities.orderBy("entity_id").select("tier").collect()]
    assert tiers == sorted(tiers)


def test_assignments_cover_every_row_once(spark):
    data = rows(12, 200)
    found = resolution.resolve(spark.createDataFrame(data, COLUMNS), ["row_no"])
    pairs = found.assignments("row_no").collect()
    assert sorted(r.row_no for r in pairs) == list(range(200))
    sizes = Counter(r.entity_id for r in pairs)
    assert sizes == {r.entity_id: r.n_raw_rows for r in found.entity_map.collect()}
    assert "tier_key" not in found.assignments().columns


def test_summary_and_conflicts(spark):
    data = rows(13, 150)
    found = resolution.resolve(spark.createDataFrame(data, COLUMNS), ["row_no"])
    entities = found.entities.collect()
    summary = {r.tier: r for r in found.summary.collect()}
    assert summary["total"].row_count == 150 == sum(summary[t].row_count for t in ("phone", "host", "name"))
    assert summary["total"].entity_count == len(entities)
    assert summary["total"].dedup_ratio == round(150 / len(entities), 1)
    conflicts = {r.entity_id for r in found.conflicts.collect()}
    assert conflicts == {
        r.entity_id for r in entities if max(r.unique_phones, r.unique_domains, r.unique_names) > 1
    }
    top = [r.n_raw_rows for r in found.top_entities(3).collect()]
    assert top == sorted((r.n_raw_rows for r in entities), reverse=True)[:3]


def test_rows_without_phone_do_not_join_the_phone_company_of_their_host(spark):
    data = [
        (1, "A", "2000000001", "a.io", "ERP", "2026-06-01"),
        (2, "A", None, "a.io", "ERP", "2026-06-02"),
        (3, "A", None, None, "ERP", "2026-06-03"),
    ]
    found = resolution.resolve(spark.createDataFrame(data, COLUMNS), ["row_no"])
    assert found.entity_map.count() == 3


def test_order_of_several_columns(spark):
    """The first name in file order leads, whatever the row numbers say."""
    data = [("b.csv", 0, 1, "acme legal"), ("a.csv", 0, 9, "acme legall"), ("a.csv", 0, 12, "acme legalll")]
    clean = spark.createDataFrame(
        [(*d, None, None, None, None) for d in data],
        "_source_file string, _block_start long, _row_seq long, company_name string, phone_clean string, "
        "website_clean string, category string, scrape_date string",
    )
    found = resolution.resolve(clean)
    assert [r[0] for r in found.clusters.select("leader_name").distinct().collect()] == ["acme legall"]


def test_unknown_option(spark):
    with pytest.raises(ValueError):
        resolution.resolve(spark.createDataFrame(rows(1, 3), COLUMNS), ["row_no"], nameless="drop")


def test_rows_without_signals_stay_apart_at_any_threshold(spark):
    rows = [(None, None, None, None, None, "scrape_2026-06-01.csv", 0, i) for i in range(6)]
    schema = "phone_clean string, website_clean string, company_name string, category string, scrape_date string, _source_file string, _block_start bigint, _row_seq bigint"
    clean = spark.createDataFrame(rows, schema)
    for pct in (100, 90):
        assert resolution.resolve(clean, pct=pct, nameless="singleton").entities.count() == 6
        assert resolution.resolve(clean, pct=pct).entities.count() == 1
