"""The similarity join and the clustering against brute force."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from scrapeloom.operators import similar_names
from scrapeloom.operators.graph import connected_components
from scrapeloom.operators.pair_ranges import PairRanges
from scrapeloom.operators.similar_names import NameJoin, leader_clusters

WORDS = "acme north star legal medical cloud works group labs point hub rx pulse data soft tech".split()


def edit(rng, name):
    chars = list(name)
    for _ in range(rng.randint(1, 3)):
        at = rng.randrange(len(chars) + 1)
        action = rng.randrange(3)
        if action == 0:
            chars.insert(at, rng.choice("abcdef "))
        elif chars and at < len(chars):
            if action == 1:
                del chars[at]
            else:
                chars[at] = rng.choice("abcdef ")
    return "".join(chars)


def sample(seed, n, words=(1, 5)):
    rng = random.Random(seed)
    names, pool = [], []
    while len(names) < n:
        name = " ".join(rng.choice(WORDS) for _ in range(rng.randint(*words)))
        if pool and rng.random() < 0.6:
            name = edit(rng, rng.choice(pool))
        if name not in pool:
            pool.append(name)
            names.append(name)
    return names


def near_copies(n):
    return [f"university of technology and science campus {i:04d}" for i in range(n)]


def walk(names, pct):
    """The sequential walk: first earlier leader that is similar enough."""
    leaders, out = [], {}
    for name in names:
        lead = next(
            (x for x in leaders if SequenceMatcher(None, name, x).ratio() >= pct / 100), None
        )
        if lead is None:
            leaders.append(name)
            lead = name
        out[name] = lead
    return out


def frame(spark, names):
    return spark.createDataFrame(list(enumerate(names, 1)), "ord long, name string")


def clusters(spark, names, pct=90, **tuning):
    found = leader_clusters(frame(spark, names), pct, **tuning).collect()
    assert len(found) == len(names)
    return {r.name: r.leader_name for r in found}


@pytest.mark.parametrize("pct", [90, 80])
def test_clusters_equal_the_sequential_walk(spark, pct):
    names = sample(1, 250) + [""]
    assert clusters(spark, names, pct) == walk(names, pct)


def test_long_names_meet_on_grams(spark):
    names = sample(2, 150, (1, 9))
    assert clusters(spark, names, limit=16) == walk(names, 90)


def test_names_that_meet_leaders_only(spark):
    """The first names walk alone, the others meet their leaders, more than once."""
    names = list(dict.fromkeys(sample(4, 25) + near_copies(60) + sample(3, 25)))
    firsts, first_names = [], similar_names._first_names

    def watched(*args):
        firsts.append(first_names(*args))
        return firsts[-1]

    similar_names._first_names = watched
    try:
        assert clusters(spark, names, effort=0.04) == walk(names, 90)
    finally:
        similar_names._first_names = first_names
    assert 1 <= len(firsts) <= 6, firsts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_no_pair_within_the_budget_is_missed(spark):
    names = sample(5, 120, (1, 7)) + near_copies(30)
    expected = {
        (j, i)
        for j in range(1, len(names) + 1)
        for i in range(1, j)
        if distance(names[j - 1], names[i - 1]) <= (len(names[j - 1]) + len(names[i - 1])) // 10
    }
    for limit in (64, 20):
        found = NameJoin(frame(spark, names), 90, limit, swaps=True).candidates(frame(spark, names))
        pairs = [(r.later, r.earlier) for r in found.collect()]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == expected
    join = NameJoin(frame(spark, names), 90)
    similar = join.verified(join.candidates(frame(spark, names)))
    assert {tuple(r) for r in similar.collect()} == {
        (j, i) for j, i in expected if SequenceMatcher(None, names[j - 1], names[i - 1]).ratio() >= 0.9
    }


def chain(n):
    """Each name is like its neighbours only; all are one connected part."""
    return ["".join(chr(97 + (i + j) // 40 % 26) for j in range(40)) for i in range(0, 4 * n, 4)]


def test_a_chain_costs_a_fixed_number_of_jobs(spark):
    """300 names of which each resembles the last: no round per name."""
    names = chain(260)
    assert len(set(names)) == 260
    expected = walk(names, 90)
    assert 2 < len(set(expected.values())) < 260
    runs, write = [], similar_names.cut

    def counted(df, label="cut"):
        runs.append(label)
        return write(df, label)

    similar_names.cut = counted
    try:
        assert clusters(spark, names) == expected
        one_task = len(runs)
        assert one_task < 10
        assert clusters(spark, names, walk_links=len(names) * 20) == expected
    finally:
        similar_names.cut = write


@pytest.mark.parametrize("walk_links", [40, 5])
def test_parts_of_any_size_walk_alike(spark, walk_links):
    """Small parts in packed tasks, large ones in rounds."""
    names = list(dict.fromkeys(sample(6, 80) + near_copies(25) + chain(12)))
    assert clusters(spark, names, walk_links=walk_links) == walk(names, 90)


def blocks_of(spark, n):
    """A block that all rows share, a smaller one, and many of a few rows."""
    rows = spark.range(0, n).select(F.col("id").alias("ord"))
    return (
        rows.select(F.lit(1).cast("bigint").alias("block"), "ord")
        .unionByName(rows.where(F.col("ord") < n // 7).select(F.lit(2).cast("bigint").alias("block"), "ord"))
        .unionByName(rows.select((F.col("ord") % (n // 5) + 10).alias("block"), "ord"))
    )


def test_every_pair_of_a_block_meets_once(spark):
    side = blocks_of(spark, 300)
    lone = spark.createDataFrame([(1, 9999), (5000, 3)], "block long, ord long")
    for left, right in ((side, side), (lone, side), (side, lone)):
        ranges = PairRanges(left, right, tasks=16)
        a, b = ranges.sides()
        shared = a.join(b.withColumnRenamed("ord", "other"), ["_range", "block", "_tile"]).select("block", "ord", "other")
        exact = left.join(right.withColumnRenamed("ord", "other"), "block").select("block", "ord", "other")
        assert sorted(shared.collect()) == sorted(exact.collect())
        assert ranges.pairs == exact.count()


@pytest.mark.parametrize("lonely", [False, True])
def test_pairs_are_dealt_evenly(spark, lonely):
    """5,000 near copies that share a piece, or one name that 5,000 resemble."""
    side = blocks_of(spark, 5000)
    left = spark.createDataFrame([(1, 9999)], "block long, ord long") if lonely else side
    ranges = PairRanges(left, side, tasks=16)
    tiles = [x.groupBy("_range", "block", "_tile").agg(F.count("*").alias(n)) for x, n in zip(ranges.sides(), "ab")]
    both = tiles[0].join(tiles[1], ["_range", "block", "_tile"])
    work = both.groupBy("_range").agg(F.sum(F.col("a") * F.col("b") + F.col("a") + F.col("b")).alias("work"))
    work = sorted(r.work for r in work.collect())
    assert len(work) == 16 and work[-1] <= 3 * work[8]
    assert both.agg(F.sum(F.col("a") * F.col("b"))).first()[0] == ranges.pairs


def test_shares_stay_with_their_tasks(spark):
    """The plan sends each range to the task of its number, whatever the session's settings."""
    join = NameJoin(frame(spark, near_copies(40)), 90)
    pairs = join.candidates(frame(spark, near_copies(40)))
    text = pairs._jdf.queryExecution().executedPlan().toString()
    assert text.count("shufflepartitionidpassthrough") == 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 300)]
    links += [(500, i) for i in range(501, 540)] + [(7, 7), (600, 600)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    least = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == {n: c for n, c in least.items() if n in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_threshold_limits(spark):
    with pytest.raises(ValueError):
        NameJoin(frame(spark, ["a"]), 60)
    assert clusters(spark, ["b", "a"], 100) == {"a": "a", "b": "b"}


def test_counts_of_characters_lose_no_pair(spark):
    """Characters of several bytes and ones that come more often than their bits count, with edits anywhere."""
    rng = random.Random(11)
    stems = ["a" * 30 + "bé" * 6, "ÄÖÜß straße 😀😀 und noch 😀 mehr", "1010101010 2020202020 qaqaqa", "xyz", "mississippi missouri"]
    names = list(dict.fromkeys(stems + [edit(rng, rng.choice(stems)) for _ in range(110)]))
    expected = {
        (j, i)
        for j in range(1, len(names) + 1)
        for i in range(1, j)
        if distance(names[j - 1], names[i - 1]) <= (len(names[j - 1]) + len(names[i - 1])) // 10
    }
    assert len(expected) > 300
    for limit in (100, 25):
        found = similar_names.similar_pairs(frame(spark, names), 90, limit).collect()
        assert {(r.later, r.earlier) for r in found} == expected and len(found) == len(expected)
        assert all((r.later_name, r.earlier_name) == (names[r.later - 1], names[r.earlier - 1]) for r in found)
    assert clusters(spark, names) == walk(names, 90)


def test_pieces_are_made_by_all_tasks(spark):
    """Names that lie in one file do not leave the hundreds of pieces of each to one task."""
    tasks, write = [], similar_names.cut

    def watched(df, label="cut"):
        if label == "pieces":
            tasks.append(df.rdd.getNumPartitions())
        return write(df, label)

    similar_names.cut = watched
    try:
        similar_names.similar_pairs(frame(spark, sample(8, 60)).coalesce(1)).collect()
    finally:
        similar_names.cut = write
    assert len(tasks) == 2 and min(tasks) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_pairs_that_share_a_piece_only_are_told_apart_by_counts(spark):
    """Names that end alike: their edits are not counted one by one."""
    rng = random.Random(12)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwx") for _ in range(40)) + " incorporated" for _ in range(60)]
    join = NameJoin(frame(spark, names), 90, swaps=True)
    ranges = join.ranges(frame(spark, names))
    conditions, meet = [], ranges.meet
    ranges.meet = lambda condition: conditions.append(condition) or meet(condition)
    assert join.within(ranges).count() == 0
    counts = conditions[0].split(" and if(")[0]
    assert "levenshtein" not in counts and ranges.pairs > 2000
    assert meet(counts).count() < ranges.pairs / 10
