"""Whole rows of the exact dedup: which are shuffled, and which stay."""

from collections import Counter

from pyspark.sql import functions as F

from scrapeloom.llm import common, exact_dedup

SCHEMA = "doc_id bigint, text string, lang string"


def test_bitmap_marks_all_wanted_rows_and_keeps_the_others(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), "id")
    wanted = spark.createDataFrame([(i,) for i in range(0, 2000, 7)] + [(None,)], "k bigint")
    marked = common.marked_likely(rows, F.col("k"), wanted).collect()
    assert Counter(r.id for r in marked) == Counter(range(2000))
    assert all(r._likely for r in marked if r.k is None or r.k % 7 == 0)
    assert sum(r._likely for r in marked if r.k is not None and r.k % 7) < 5
    assert not any(r._likely for r in common.marked_likely(rows, F.col("k"), wanted.limit(0)).collect())
    likely = common.likely(rows, F.col("k"), wanted)
    assert likely.columns == rows.columns and likely.count() == sum(r._likely for r in marked)


def test_rows_that_no_copy_concerns_are_not_shuffled(spark):
    """Also where the list of copies is too large to broadcast."""
    rows = [(i, f"text {i}", "en") for i in range(200)] + [(i, f"text {i % 20}", "de") for i in range(500, 560)]
    rows += [(3, "text  3", "fr"), (None, "lone", "en"), (None, "lone", "de"), (700, "text 700", "en"), (700, "text 700", "en")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup.drop_duplicates(spark.createDataFrame(rows, SCHEMA))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        found = [tuple(r) for r in kept.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert set(found) <= set(rows)
    assert Counter(r[1].replace("  ", " ") for r in found) == Counter({r[1].replace("  ", " "): 1 for r in rows})
    assert all(r[0] == int(r[1].split()[1]) for r in found if r[0] is not None)
