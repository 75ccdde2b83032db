"""Physical plans: what must and must not be in them."""

import ast
from pathlib import Path

from scrapeloom.operators import cleaning, profiling, resolution
from scrapeloom.plans import reports
from scrapeloom.plans import star as model
from workload.registry import QUERIES
from workload.stages import Stages

ROOT = Path(__file__).resolve().parents[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_is_one_narrow_pass(spark, sf_dir):
    text = plan(cleaning.clean_scrape(Stages(spark, sf_dir).raw))
    assert "Exchange" not in text and "Python" not in text


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    text = plan(profiling.top_countries(Stages(spark, sf_dir).raw))
    assert "ReadSchema: struct<country:string>" in text
    assert "IsNotNull(country)" in text


def test_row_level_aggregates_hash(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    for df in (
        profiling.rows_per_day(stages.raw),
        profiling.category_variants(stages.raw),
        profiling.phone_stability(stages.clean, "host"),
        profiling.malformed_emails(stages.clean),
        resolution._facets(resolution.add_signals(stages.clean), None),
        reports.daily_unique_phones(stages.star()),
    ):
        assert "SortAggregate" not in plan(df)


def test_fact_broadcasts_small_dimensions_by_their_size(spark, sf_dir):
    stages = Stages(spark, sf_dir)
    star = stages.star()
    entity_map = stages.resolution().entity_map
    args = (stages.clean, star.dim_category, entity_map, star.dim_location)
    text = plan(model.fact_scrape(*args))
    assert text.count("BroadcastHashJoin") >= 3
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Window" not in text
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:  # a dimension beyond the limit is shuffled instead
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        text = plan(model.fact_scrape(*args))
        assert text.count("SortMergeJoin") >= 3 and "NestedLoop" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_query_multiplies_tables(spark, sf_dir):
    for name, build in QUERIES.items():
        if name.startswith(("csv_", "report_files", "written_")):
            continue
        text = plan(build(spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_python_functions_and_no_unbounded_collect():
    """The ratio, the walk and the proof of a stream are the only Python; nothing collects,
    caches or checkpoints locally. The optional corpus operators have a test of their own."""
    calls = {}
    for path in (ROOT / "scrapeloom").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            name = getattr(node, "attr", None)
            if name:
                calls.setdefault(name, set()).add(path.stem)
    assert calls["pandas_udf"] == {"similarity"} and calls["applyInPandas"] == {"similar_names"}
    assert calls["mapInArrow"] == {"daily_csv"}
    for banned in ("udf", "collect", "toPandas", "rdd", "localCheckpoint", "cache", "persist", "crossJoin"):
        assert banned not in calls, (banned, calls[banned])


def test_hot_keys_are_split_when_the_entity_map_is_large(spark):
    """A phone with a third of all rows, a third without phone, no broadcast."""
    from pyspark.sql import functions as F

    rows = spark.range(0, 30_000, 1, 8)
    phone = F.when(F.col("id") % 3 == 0, "2000000000").when(
        F.col("id") % 3 == 1, F.format_string("%010d", F.col("id"))
    )
    text = {c: F.concat(F.lit(c), F.sha2(F.col("id").cast("string"), 256)) for c in ("email_clean", "website_clean", "company_name", "scraped_at")}
    clean = rows.select(
        F.lit("2026-06-01").alias("scrape_date"), phone.alias("phone_clean"), F.lit("ERP").alias("category"),
        F.lit(None).cast("string").alias("city"), F.lit("IT").alias("country"), F.lit("f").alias("_source_file"),
        F.lit("1-10").alias("employee_count"), *[c.alias(n) for n, c in text.items()],
    )
    entity_map = rows.select((F.col("id") + 1).alias("entity_id"), F.format_string("%010d", F.col("id")).alias("canonical_phone"))
    entity_map = entity_map.unionByName(spark.sql("select 0L entity_id, '2000000000' canonical_phone"))
    categories = spark.createDataFrame([(1, "ERP")], "category_id long, category_name string")
    places = spark.createDataFrame([(1, None, "IT")], "location_id long, city string, country string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "1000b",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "1000b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = model.fact_scrape(clean, categories, entity_map, places)
        links = fact.select("phone_clean", "entity_id", "email_clean", "website_clean", "scraped_at")
        linked = links.collect()
        assert "SortMergeJoin(skew=true)" in plan(links)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(linked) == 30_000
    for r in linked:
        expected = -1 if r.phone_clean is None else 0 if r.phone_clean == "2000000000" else int(r.phone_clean) + 1
        assert r.entity_id == expected
