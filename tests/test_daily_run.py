"""The chain of stages from files to published tables."""

import pytest

from scrapeloom.plans.daily_run import run_stages
from scrapeloom.sources.daily_csv import CONTRACT
from scrapeloom.sources.tables import PublicationConflict, Warehouse

COMPANIES = [
    ("Acme Legal", "(832) 516-2691 ext. 2", "Lgl", "https://www.acme.io/a"),
    ("Borealis", "18325162692", "ERP", "borealis.io"),
    ("Borealis Two", "N/A", "HR", "http://two.io:80"),
    ("Nowhere Legal Group", "", "Legal", ""),
    ("Nowhere Legal Groupp", "-", "LMS", "nan"),
]


def write_days(folder, days):
    for day in days:
        lines = [",".join(CONTRACT)]
        for name, phone, category, site in COMPANIES:
            cells = {"scrape_date": day, "company_name": name, "phone": phone, "category": category, "website": site,
                     "email": "a@b.io", "city": "-", "country": "US", "scraped_at": day}
            lines.append(",".join(cells.get(c, "") for c in CONTRACT))
        lines.append(",".join(CONTRACT))
        (folder / f"scrape_{day}.csv").write_text("\n".join(lines) + "\n")


def test_run_publishes_all_tables(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    write_days(folder, ["2026-06-01", "2026-06-02"])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    with pytest.raises(LookupError):
        warehouse.current_run()
    result = run_stages(spark, str(folder), warehouse, "first")
    assert result.published and warehouse.current_run() == "first"
    assert warehouse.read("raw_scrape").count() == 12
    assert warehouse.read("clean_scrape").count() == 10
    entities = {r.canonical_name: r for r in warehouse.read("entity_map").collect()}
    assert set(entities) == {"Acme Legal", "Borealis", "Borealis Two", "Nowhere Legal Group"}
    assert entities["Nowhere Legal Group"].categories == "LMS|Legal"
    assert entities["Nowhere Legal Group"].n_raw_rows == 4
    assert result.report_rows == {
        "q1_daily_unique_phones": 8, "q2_new_vs_returning": 2, "q3_cross_category_entities": 1,
        "q4_top_domains": 3, "q5_weekly_change": 4,
    }
    csv = spark.read.option("header", True).csv(warehouse.path("first", "reports/q2_new_vs_returning"))
    assert [tuple(r) for r in csv.orderBy("scrape_date").collect()] == [("2026-06-01", "2", "0"), ("2026-06-02", "0", "2")]
    exported = spark.read.option("header", True).csv(warehouse.path("first", "entity_map_csv"))
    assert exported.columns == ["entity_id", "canonical_name", "canonical_phone", "categories", "n_raw_rows"]

    # a run that fails a blocking gate leaves the published one in place
    result = run_stages(spark, str(folder), warehouse, "second", blocking=("phone_not_null",))
    assert not result.published and warehouse.current_run() == "first"

    # so does a failed attempt under the id of the published run
    (folder / "scrape_2026-06-02.csv").write_text(",".join(CONTRACT) + "\n")
    result = run_stages(spark, str(folder), warehouse, "first", blocking=("phone_not_null",))
    assert not result.published and Warehouse(spark, warehouse.root).read("raw_scrape").count() == 12


def test_companies_keep_their_numbers(spark, tmp_path):
    """A new day brings companies that sort before the old ones; one of the old is gone."""
    folder = tmp_path / "daily"
    folder.mkdir()
    write_days(folder, ["2026-06-01"])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    assert run_stages(spark, str(folder), warehouse, "first").published
    before = {r.canonical_name: r.entity_id for r in warehouse.read("entity_map").collect()}
    assert sorted(before.values()) == [1, 2, 3, 4]
    text = (folder / "scrape_2026-06-01.csv").read_text()
    gone = [x for x in text.splitlines() if "Borealis Two" not in x]
    day = "2026-06-02"
    new = ",".join({"scrape_date": day, "company_name": "Aaa", "phone": "2000000000", "category": "ERP", "scraped_at": day}.get(c, "") for c in CONTRACT)
    (folder / "scrape_2026-06-01.csv").write_text("\n".join(gone) + "\n")
    (folder / "scrape_2026-06-02.csv").write_text("\n".join([",".join(CONTRACT), new]) + "\n")
    assert run_stages(spark, str(folder), warehouse, "second").published
    after = {r.canonical_name: r.entity_id for r in warehouse.read("entity_map").collect()}
    assert after == {**{k: v for k, v in before.items() if k != "Borealis Two"}, "Aaa": 5}
    ids = warehouse.read("entity_ids")
    assert ids.count() == ids.select("entity_id").distinct().count() == 5  # no number is given again
    summary = {r.tier: r.row_count for r in warehouse.read("resolution_summary").collect()}
    assert summary["total"] == warehouse.read("clean_scrape").count()
    assert {r.table_name for r in warehouse.read("model_row_counts").collect()} >= {"dim_entity", "fact_scrape"}


def test_of_two_writers_one_publishes(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    writers = [Warehouse(spark, str(tmp_path)) for _ in range(4)]
    for i, w in enumerate(writers):
        w.begin(f"r{i}")
        w.write(f"r{i}", "t", spark.range(i + 1))

    def publish(i):
        try:
            return writers[i].publish(f"r{i}")
        except PublicationConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(publish, range(4)))
    winner = numbers.index(1)
    assert sorted(map(str, numbers)) == ["1", "None", "None", "None"]
    assert Warehouse(spark, str(tmp_path)).current_run() == f"r{winner}"
    assert Warehouse(spark, str(tmp_path)).read("t").count() == winner + 1
    late = next(i for i in range(4) if i != winner)
    writers[late].begin("again")
    writers[late].write("again", "t", spark.range(9))
    assert writers[late].publish("again") == 2
    assert writers[winner].current_run() == "again"


def test_reconciliation_finds_lost_rows(spark, tmp_path):
    from scrapeloom.operators.quality import reconcile

    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.write("r", "t", spark.range(5)).first().matches
    assert not reconcile("t", warehouse.read("t", "r"), 6).first().matches
