"""Days replaced one by one, first days kept as a state, sketches that merge."""

import re

import pytest
from pyspark.sql import functions as F

from scrapeloom.plans import increments
from scrapeloom.sources.daily_table import DailyTable

SCHEMA = "scrape_date string, id int"


def rows_of(df):
    return sorted((r.scrape_date or "", r.id) for r in df.collect())


def files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_one_day_is_replaced_and_no_other_written(spark, tmp_path):
    table = DailyTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.loads() is None
    assert table.load(spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("x/y=1", 3), (None, 4)], SCHEMA)) == 1
    before = files_of(tmp_path / "t" / "rows")
    assert table.load(spark.createDataFrame([("2024-01-02", 5), ("2024-01-02", 6)], SCHEMA)) == 2
    after = files_of(tmp_path / "t" / "rows")
    assert {p for p in before if before[p] != after.get(p)} == {p for p in before if "2024-01-02" in p}
    assert rows_of(table.read()) == [("", 4), ("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-02", 6), ("x/y=1", 3)]
    table.load(spark.createDataFrame([], SCHEMA), days=["x/y=1", "2024-01-01", "never there"])
    assert rows_of(table.read()) == [("", 4), ("2024-01-02", 5), ("2024-01-02", 6)]
    found = {r.day: (r.load, r.rows_expected, r.rows_found, r.matches) for r in table.check().collect()}
    assert found == {
        None: (1, 1, 1, True), "2024-01-02": (2, 2, 2, True), "2024-01-01": (3, 0, 0, True), "x/y=1": (3, 0, 0, True),
        "never there": (3, 0, 0, True),
    }


def test_rows_of_other_days_are_refused_and_lost_files_found(spark, tmp_path):
    table = DailyTable(spark, str(tmp_path / "t"))
    first = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], SCHEMA)
    table.load(first)
    for strange in ("2024-01-03", None):
        with pytest.raises(ValueError):
            table.load(spark.createDataFrame([(strange, 9)], SCHEMA), days=["2024-01-02"])
    assert rows_of(table.read()) == rows_of(first)
    for path in (tmp_path / "t" / "rows").rglob("*2024-01-01/*.parquet"):
        path.unlink()
    assert {r.day: r.matches for r in table.check().collect()} == {"2024-01-01": False, "2024-01-02": True}


def test_a_failed_load_changes_nothing(spark, tmp_path):
    table = DailyTable(spark, str(tmp_path / "t"))
    first = spark.createDataFrame([("2024-01-01", 1)], SCHEMA)
    table.load(first)
    broken = first.withColumn("id", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        table.load(broken)
    assert rows_of(table.read()) == rows_of(first) and table.loads().count() == 1


def test_columns_that_come_later_are_read(spark, tmp_path):
    table = DailyTable(spark, str(tmp_path / "t"))
    table.load(spark.createDataFrame([("2024-01-01", 1)], SCHEMA))
    table.load(spark.createDataFrame([("2024-01-02", 2, "b")], SCHEMA + ", more string"))
    assert {(r.id, r.more) for r in table.read().collect()} == {(1, None), (2, "b")}


def test_a_filter_on_the_day_reads_its_folder_only(spark, tmp_path):
    table = DailyTable(spark, str(tmp_path / "t"))
    table.load(spark.createDataFrame([(f"2024-01-{d:02d}", d) for d in range(1, 20)], SCHEMA))
    one = table.read().where(F.col("scrape_date") == "2024-01-07")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-07", text)
    assert [r.id for r in one.collect()] == [7] and dict(one.dtypes)["scrape_date"] == "string"


FACT = "date_id string, entity_id bigint, category_id int, phone_clean string"


def test_first_days_grow_by_day_and_repeat(spark, tmp_path):
    visits = {"2024-01-01": [1, 2, 2, -1], "2024-01-02": [2, 3], "2024-01-03": [-1], "2024-01-04": [1, 4, 5]}
    fact = spark.createDataFrame([(d, e, 1, None) for d, es in visits.items() for e in es], FACT)
    state = increments.FirstSeen(DailyTable(spark, str(tmp_path / "s"), "first_day"))

    def day(d, entities=None):
        rows = fact.where(F.col("date_id") == d) if entities is None else spark.createDataFrame([(d, e, 1, None) for e in entities], FACT)
        return [tuple(r) for r in state.advance(d, rows).collect()]

    assert day("2024-01-01") == [("2024-01-01", 2, 0)]
    assert day("2024-01-02") == [("2024-01-02", 1, 1)]
    assert day("2024-01-03") == []
    assert day("2024-01-04") == [("2024-01-04", 2, 1)]
    assert day("2024-01-04", [2, 6]) == [("2024-01-04", 1, 1)]  # the day again, with other rows
    with pytest.raises(ValueError):
        day("2024-01-02")
    state.take_back("2024-01-02")
    assert day("2024-01-02", [1]) == [("2024-01-02", 0, 1)]
    state.build(fact)
    kept = {r.entity_id: r.first_day for r in state.table.read().collect()}
    assert kept == {1: "2024-01-01", 2: "2024-01-01", 3: "2024-01-02", 4: "2024-01-04", 5: "2024-01-04"}


def test_sketches_of_days_merge_to_any_period(spark):
    phones = [(f"2024-01-{d:02d}", 0, c, f"{(n * 7 + d * 500) % 20_000:010d}") for d in range(1, 8) for c in (1, 2) for n in range(3000)]
    fact = spark.createDataFrame([*phones, ("2024-01-01", 0, 3, None), ("2024-01-01", 0, None, "1")], FACT)
    sketches = increments.daily_sketches(fact)
    assert sketches.count() == 15
    exact = {c: len({p for _, _, k, p in phones if k == c}) for c in (1, 2)} | {3: 0}
    for r in increments.estimated_phones(sketches, "category_id").collect():
        assert abs(r.estimated_phones - exact[r.category_id]) <= 0.03 * exact[r.category_id]
