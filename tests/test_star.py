"""Star schema and reports on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from scrapeloom.functions.contact import canonical_labels
from scrapeloom.operators import cleaning, common, profiling, quality, resolution
from scrapeloom.plans import reports
from scrapeloom.plans import star as model
from tests import compare
from workload.stages import Stages

FACT = "date_id string, category_id long, entity_id long, phone_clean string, website_clean string"


def star_of(spark, facts, categories=((1, "ERP"), (2, "HR"))):
    fact = spark.createDataFrame(facts, FACT)
    clean = fact.select(F.col("date_id").alias("scrape_date"))
    return model.Star(
        dim_date=model.dim_date(clean),
        dim_category=spark.createDataFrame(list(categories), "category_id long, category_name string"),
        dim_entity=None,
        dim_location=None,
        fact_scrape=fact,
    )


def phones(week, label, n, first=0):
    return [(week, label, 1, f"{first + i:010d}", None) for i in range(n)]


def test_weekly_change_guards_and_gaps(spark):
    facts = (
        phones("2026-06-01", 1, 100) + phones("2026-06-08", 1, 110)
        + [("2026-06-15", 1, 1, None, None)] + phones("2026-06-24", 1, 5)
        + phones("2026-06-02", 2, 3) + phones("2026-06-23", 2, 6)
        + [("2026-06-23", None, 1, "9", None)]
    )
    star = star_of(spark, facts)
    got = {(r.week_start, r.category): (r.unique_phones, r.pct_change) for r in reports.weekly_change(star).collect()}
    assert got == {
        ("2026-06-01", "ERP"): (100, None), ("2026-06-08", "ERP"): (110, 10.0),
        ("2026-06-15", "ERP"): (0, -100.0), ("2026-06-22", "ERP"): (5, None),
        ("2026-06-01", "HR"): (3, None), ("2026-06-22", "HR"): (6, 100.0),
    }
    calendar = {
        (r.week_start, r.category): r.pct_change for r in reports.weekly_change(star, calendar=True).collect()
    }
    assert calendar[("2026-06-22", "HR")] is None and calendar[("2026-06-08", "ERP")] == 10.0


def test_new_and_returning(spark):
    facts = [
        (day, 1, entity, None, None)
        for day, entity in [
            ("d1", 1), ("d1", 1), ("d1", 2), ("d2", 1), ("d2", 3), ("d2", -1), ("d3", 2), ("d3", 3), ("d4", -1),
        ]
    ]
    got = [tuple(r) for r in reports.new_and_returning(star_of(spark, facts)).collect()]
    assert got == [("d1", 2, 0), ("d2", 1, 1), ("d3", 0, 2)]


def test_top_sites_tie_break(spark):
    sites = ["http://www.b.io", "https://B.io", "c.io", "a.io", None]
    facts = [("d", 1, 1, None, s) for s in sites]
    got = reports.top_sites(star_of(spark, facts).fact_scrape, k=2).collect()
    assert [tuple(r) for r in got] == [("b.io", 2), ("a.io", 1)]


def test_cross_category(spark):
    star = star_of(spark, [("d", 1, 1, None, None)])
    star.dim_entity = spark.createDataFrame(
        [(1, "b", "HR|Legal"), (2, "a", "HR"), (3, "a", "HR|Unknown"), (4, None, "")],
        "entity_id long, canonical_name string, all_categories string",
    ).withColumn("first_seen", F.lit("x"))
    assert [r[0] for r in reports.cross_category_entities(star).collect()] == ["a", "b"]
    assert [r[0] for r in reports.cross_category_entities(star, exclude_unknown=True).collect()] == ["b"]


CLEAN = (
    "scrape_date string, category string, company_name string, phone_clean string, email_clean string, "
    "website_clean string, employee_count string, city string, country string, scraped_at string, "
    "_source_file string"
)


def clean_rows(spark, *rows):
    base = dict.fromkeys(c.split()[0] for c in CLEAN.split(", "))
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], CLEAN)


def test_fact_keys_and_sentinels(spark):
    clean = clean_rows(
        spark,
        {"scrape_date": "2026-06-01", "category": "ERP", "phone_clean": "2000000001", "city": "Rome", "country": "IT"},
        {"scrape_date": "2026-06-01", "category": "Unknown", "phone_clean": None, "city": None, "country": "IT"},
        {"scrape_date": "2026-06-02", "category": None, "phone_clean": "2000000009", "city": "Rome", "country": None},
        {"scrape_date": "2026-06-02", "category": "HR", "phone_clean": "2000000001", "city": " - ", "country": "IT"},
        {"scrape_date": None, "category": "HR", "phone_clean": "2000000001"},
    )
    entity_map = spark.createDataFrame(
        [(7, "2000000001"), (8, None)], "entity_id long, canonical_phone string"
    ).selectExpr("entity_id", "'n' canonical_name", "canonical_phone", "'' categories", "1L n_raw_rows", "'' first_seen")
    star = model.build_star(clean, entity_map)
    fact = [
        (r.date_id, r.category_id, r.entity_id, r.location_id)
        for r in star.fact_scrape.orderBy("date_id", F.desc("category_id")).collect()
    ]
    # the placeholder city is NULL in the dimension but not in the row
    assert fact == [
        ("2026-06-01", 1, 7, 1), ("2026-06-01", None, -1, 2), ("2026-06-02", 2, 7, -1), ("2026-06-02", None, -1, -1),
    ]
    assert [tuple(r) for r in star.dim_location.orderBy("location_id").collect()] == [(1, "Rome", "IT"), (2, None, "IT")]
    assert [tuple(r) for r in star.dim_category.orderBy("category_id").collect()] == [(1, "ERP"), (2, "HR")]
    assert {r.table_name: r.row_count for r in star.row_counts().collect()}["fact_scrape"] == 4
    assert star.fact_scrape.select("fact_id").distinct().count() == 4


def test_bad_dates_are_set_aside(spark):
    clean = clean_rows(spark, {"scrape_date": "2026-02-30"}, {"scrape_date": "2026-02-28"}, {})
    assert [r[0] for r in model.dim_date(clean).select("date_id").collect()] == ["2026-02-28"]
    assert [r[0] for r in model.bad_dates(clean).select("scrape_date").collect()] == ["2026-02-30"]


def test_unknown_link(spark):
    with pytest.raises(ValueError):
        model.fact_scrape(clean_rows(spark, {}), None, None, None, link="name")


def test_invariants_on_the_workload(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    star, clean = stages.star(), stages.clean
    assert star.fact_scrape.count() == clean.where("scrape_date is not null").count()
    q2 = reports.new_and_returning(star).agg(F.sum("new_entities")).first()[0]
    assert q2 == star.fact_scrape.where("entity_id <> -1").select("entity_id").distinct().count()
    daily = star.fact_scrape.where("entity_id <> -1").groupBy("date_id").agg(F.count_distinct("entity_id").alias("n"))
    both = reports.new_and_returning(star).withColumnRenamed("scrape_date", "date_id").join(daily, "date_id")
    assert both.where("new_entities + returning_entities <> n").isEmpty()
    assert stages.resolution().entity_map.agg(F.sum("n_raw_rows")).first()[0] == clean.count()


def test_quality_gates(spark):
    clean = clean_rows(
        spark,
        *[{"scrape_date": f"2026-06-{d:02d}", "category": "ERP", "phone_clean": "2000000001"} for d in range(1, 9) for _ in range(10)],
        *[{"scrape_date": "2026-06-09", "category": "Unknown", "phone_clean": None}] * 5,
        {"scrape_date": "2026-06-08", "category": None, "phone_clean": "12"},
    )
    ids = spark.createDataFrame([(1,), (2,), (2,)], "entity_id long")
    report = {r.check_name: (r.failures, r.passed) for r in quality.gate_report(clean, ids).collect()}
    assert report == {
        "phone_not_null": (5, False), "category_canonical": (6, False), "phone_ten_digits": (1, False),
        "entity_id_unique": (1, False), "daily_volume_in_band": (1, False),
    }
    days = {r.scrape_date: r.within_band for r in profiling.rolling_volume(clean).collect()}
    assert [d for d, ok in days.items() if not ok] == ["2026-06-09"]
    gap = profiling.rolling_volume(clean.where("scrape_date <> '2026-06-06'")).collect()
    assert [(r.scrape_date, r.row_count) for r in gap if not r.within_band][0] == ("2026-06-06", 0)
    assert quality.violations(clean, "phone_ten_digits").count() == 1
    assert canonical_labels() == ["ERP", "HR", "LMS", "Legal", "MSP Platform", "Medical"]


def test_clean_keeps_rows_with_nulls_and_drops_header_lines(spark):
    raw = spark.createDataFrame(
        [("2026-06-01", "category", "x"), ("scrape_date", None, None), (None, None, "company_name"), (None, None, None),
         ("2026-06-01", " category", "y")],
        "scrape_date string, category string, company_name string",
    )
    kept = cleaning.drop_header_rows(raw)
    assert compare.spark_rows(kept)[1] == sorted([("None",) * 3, ("' category'", "'y'", "'2026-06-01'")])


def test_describe_columns(spark):
    df = spark.range(1).selectExpr("id", "cast(id as string) s")
    assert [tuple(r) for r in common.describe_columns(df).collect()] == [("id", "bigint", 1), ("s", "string", 1)]


def test_dense_index_over_many_tasks(spark):
    df = spark.range(0, 1000, 1, 16).selectExpr("(id * 7919) % 1000 as v")
    got = {r.v: r.n for r in common.dense_index(df, ["v"], "n").collect()}
    assert got == {v: v + 1 for v in range(1000)}


def test_signal_counts(spark):
    clean = clean_rows(
        spark, {"phone_clean": "1", "website_clean": "a.io/x", "company_name": "A"},
        {"phone_clean": "1", "website_clean": "http://a.io", "company_name": "a"}, {},
    )
    assert {r[0]: r[1] for r in resolution.signal_counts(clean).collect()} == {"phone": 1, "host": 1, "company_name": 2}
