"""Named queries over the given tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrapeloom.functions import contact, dates, text
from scrapeloom.operators import cleaning, common, profiling, quality, resolution, similar_names
from scrapeloom.plans import increments, reports
from scrapeloom.plans import star as model
from scrapeloom.session import cut, shared_dir
from scrapeloom.sources import daily_csv, tables
from scrapeloom.sources.daily_table import DailyTable

from .stages import Stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Stages], DataFrame]) -> Callable[[Stages], DataFrame]:
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Stages(spark, sf_dir))
    return build


# --- cleaning -----------------------------------------------------------------


@query
def null_tokens(s: Stages) -> DataFrame:
    flags = [text.is_null_like(c).alias(f"{c}_missing") for c in ("category", "phone", "email", "city")]
    return s.landing.select("event_id", *flags)


@query
def drop_header_rows(s: Stages) -> DataFrame:
    return cleaning.drop_header_rows(s.landing).select("event_id", "category", "company_name", "scrape_date")


@query
def trim_text(s: Stages) -> DataFrame:
    return cleaning.tidy_text(s.landing).select("event_id", *cleaning.TEXT_COLUMNS)


@query
def clean_category(s: Stages) -> DataFrame:
    return s.landing.select(
        "event_id", F.col("category").alias("raw_category"), contact.clean_category("category").alias("category")
    )


@query
def clean_phone(s: Stages) -> DataFrame:
    rows = s.landing.select("event_id", "phone", contact.clean_phone("phone").alias("phone_clean"))
    return rows.withColumn("phone_clean_flag", contact.phone_flag("phone", "phone_clean"))


@query
def clean_email(s: Stages) -> DataFrame:
    return s.landing.select(
        "event_id",
        "email",
        contact.clean_email("email").alias("email_clean"),
        contact.email_flag("email").alias("email_clean_flag"),
    )


@query
def clean_website(s: Stages) -> DataFrame:
    return s.landing.select("event_id", "website", contact.clean_website("website").alias("website_clean"))


@query
def extract_host(s: Stages) -> DataFrame:
    return s.table("pages").select("page_id", "url", contact.site_host("url").alias("host"))


@query
def site_key(s: Stages) -> DataFrame:
    return s.table("pages").select("page_id", "url", contact.site_key("url").alias("domain"))


@query
def normalise_name(s: Stages) -> DataFrame:
    return s.landing.select("event_id", text.normalise_name("company_name").alias("normalised_name"))


@query
def normalise_document_text(s: Stages) -> DataFrame:
    return s.table("documents").select("doc_id", F.md5(text.normalise_name("text")).alias("text_md5"))


@query
def clean_scrape(s: Stages) -> DataFrame:
    return s.clean


@query
def cleaning_summary(s: Stages) -> DataFrame:
    return cleaning.cleaning_summary(s.clean)


@query
def category_change(s: Stages) -> DataFrame:
    return cleaning.category_change(s.raw)


@query
def phone_samples_ok(s: Stages) -> DataFrame:
    return cleaning.phone_samples(s.clean, "ok")


@query
def phone_samples_invalid(s: Stages) -> DataFrame:
    return cleaning.phone_samples(s.clean, "invalid")


# --- profiles -----------------------------------------------------------------


@query
def table_size(s: Stages) -> DataFrame:
    return profiling.table_size(s.raw)


@query
def describe_columns(s: Stages) -> DataFrame:
    return common.describe_columns(s.raw)


@query
def rows_per_day(s: Stages) -> DataFrame:
    return profiling.rows_per_day(s.raw)


@query
def category_share(s: Stages) -> DataFrame:
    return profiling.category_share(s.raw)


@query
def distinct_phone_sample(s: Stages) -> DataFrame:
    return common.distinct_sample(s.raw, "phone", 15)


@query
def distinct_employee_bands(s: Stages) -> DataFrame:
    return common.distinct_sample(s.raw, "employee_count", 20)


@query
def null_profile(s: Stages) -> DataFrame:
    return profiling.null_profile(s.raw)


@query
def blank_profile(s: Stages) -> DataFrame:
    return profiling.blank_profile(s.raw)


@query
def null_text_scan(s: Stages) -> DataFrame:
    return profiling.null_text_scan(s.raw)


@query
def top_countries(s: Stages) -> DataFrame:
    return profiling.top_countries(s.raw)


@query
def schema_change_trace(s: Stages) -> DataFrame:
    return profiling.schema_change_trace(s.raw)


@query
def late_column_rows(s: Stages) -> DataFrame:
    return s.raw.where(F.col("source_url").isNotNull()).select("event_id", "scrape_date", "source_url")


@query
def preview_rows(s: Stages) -> DataFrame:
    return common.preview(s.raw, 3, "event_id")


@query
def phone_digit_lengths(s: Stages) -> DataFrame:
    return profiling.phone_digit_lengths(s.raw)


@query
def category_variants(s: Stages) -> DataFrame:
    return profiling.category_variants(s.raw)


@query
def malformed_emails(s: Stages) -> DataFrame:
    return profiling.malformed_emails(s.clean)


@query
def rolling_volume_check(s: Stages) -> DataFrame:
    return profiling.rolling_volume(s.clean)


@query
def phone_stability_by_host(s: Stages) -> DataFrame:
    return profiling.phone_stability(s.clean, "host")


@query
def phone_stability_by_name(s: Stages) -> DataFrame:
    return profiling.phone_stability(s.clean, "name")


# --- sources ------------------------------------------------------------------


@query
def file_date_from_name(s: Stages) -> DataFrame:
    return s.landing.select(
        "event_id", "_source_file", dates.date_from_file_name("_source_file").alias("file_date")
    )


@query
def file_date_fallback(s: Stages) -> DataFrame:
    return daily_csv.apply_date_fallback(s.landing).select("event_id", "scrape_date", "_source_file")


@query
def union_by_name_drift(s: Stages) -> DataFrame:
    late = F.col("_file_date") >= "2024-01-15"
    early = s.landing.where(~late).drop("source_url")
    return early.unionByName(s.landing.where(late), allowMissingColumns=True)


def export_days(s: Stages) -> str:
    """Write the landing rows as daily CSV files, in the ways they arrive.

    Headers differ in case and blanks, ``source_url`` is absent before it was
    introduced, and the files of one week are not UTF-8.
    """
    folder = f"{shared_dir(s.spark)}/export-{uuid.uuid4().hex}"
    rows = cut(s.landing.withColumn("day", F.col("_file_date")).drop("_source_file", "_file_date"), "export")
    spelled = {c: c.replace("_", " ").title() + " " for c in daily_csv.CONTRACT}
    variants = [
        (rows.where("day < '2024-01-08'").drop("source_url"), "UTF-8"),
        (rows.where("day >= '2024-01-08' and day < '2024-01-15'").drop("source_url"), "ISO-8859-1"),
        (rows.where("day >= '2024-01-15' and day < '2024-01-22'"), "UTF-8"),
        (rows.where("day >= '2024-01-22'").withColumnsRenamed(spelled), "UTF-8"),
    ]
    for i, (part, encoding) in enumerate(variants):
        (
            part.write.partitionBy("day")
            .option("header", True)
            .option("encoding", encoding)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/part={i}")
        )
    return folder


def _ingested(s: Stages) -> daily_csv.Ingest:
    return daily_csv.ingest(
        s.spark, export_days(s), recursive=True, source_name=daily_csv.day_folder_name()
    )


@query
def csv_round_trip_ingest(s: Stages) -> DataFrame:
    return _ingested(s).raw.withColumn("event_id", F.col("event_id").cast("bigint"))


@query
def csv_ingest_report(s: Stages) -> DataFrame:
    return (
        _ingested(s)
        .report.groupBy("_source_file", "_file_date", "status")
        .agg(F.sum("row_count").alias("row_count"), F.sum("malformed").alias("malformed"))
    )


@query
def csv_schema_drift(s: Stages) -> DataFrame:
    return (
        _ingested(s)
        .drift.select(
            "_source_file",
            F.array_join("extra_columns", "|").alias("extra_columns"),
            F.array_join("missing_columns", "|").alias("missing_columns"),
        )
        .distinct()
    )


SHORT = daily_csv.CONTRACT[:5]  # the columns that a short line still has


def export_faulty_days(s: Stages) -> str:
    """Daily files as they arrive when things go wrong, compressed.

    Every 50th line has a field too many, the one after it only the first five. The
    file of each day that ends in 5 breaks off half way; of two more days one file
    holds a header only and one nothing.
    """
    folder = f"{shared_dir(s.spark)}/export-{uuid.uuid4().hex}"
    plain = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    columns = ["event_id", *daily_csv.CONTRACT]  # the number leads, so that a short line keeps it
    cells = [F.col(c).cast("string") for c in columns]
    whole, short = (F.to_csv(F.struct(*cells[:n]), plain) for n in (len(cells), 1 + len(SHORT)))
    turn = F.col("event_id") % 50
    value = F.when(turn == 0, F.concat(whole, F.lit(",surplus"))).when(turn == 1, short).otherwise(whole)
    lines = s.landing.select(F.col("_file_date").alias("day"), F.lit(1).alias("place"), value.alias("value"))
    header = ",".join(columns)
    headers = lines.select("day").distinct().select("day", F.lit(0).alias("place"), F.lit(header).alias("value"))
    files = lines.unionByName(headers).repartition("day").sortWithinPartitions("day", "place").drop("place")
    files.write.partitionBy("day").option("compression", "gzip").text(f"{folder}/whole")

    written = s.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/whole")
    day = F.regexp_extract("path", "day=([^/]*)/", 1)
    broken = cut(written.select(day.alias("day"), "path", "content").where(day.endswith("5")), "broken")
    half = F.substring("content", 1, (F.octet_length("content") / 2).cast("int")).cast("string")
    broken.select("day", half.alias("value")).write.partitionBy("day").text(f"{folder}/cut")
    s.spark.createDataFrame([(header,)], "value string").coalesce(1).write.text(f"{folder}/whole/day=2024-02-01")
    s.spark.createDataFrame([], "value string").coalesce(1).write.text(f"{folder}/whole/day=2024-02-02")

    # a half file takes the place and the name of the compressed one
    hadoop = s.spark._jvm.org.apache.hadoop.fs
    files_of = hadoop.Path(folder).getFileSystem(s.spark._jsc.hadoopConfiguration())
    for row in broken.select("day", "path").collect():  # names only, one a day
        target = hadoop.Path(row.path)
        files_of.delete(target, False)
        found = files_of.globStatus(hadoop.Path(f"{folder}/cut/day={row.day}/part-*"))
        files_of.rename(found[0].getPath(), target)
    return folder


def _faulty(s: Stages) -> daily_csv.Ingest:
    name = daily_csv.day_folder_name()
    return daily_csv.ingest(s.spark, f"{export_faulty_days(s)}/whole", pattern="part-*", recursive=True, source_name=name)


@query
def csv_faulty_files_report(s: Stages) -> DataFrame:
    return _faulty(s).report.select("_source_file", "status", "row_count", "malformed", "reason")


@query
def csv_rows_of_whole_files(s: Stages) -> DataFrame:
    rows = _faulty(s).raw.withColumn("event_id", F.col("event_id").cast("bigint"))
    return rows.select("event_id", *daily_csv.CONTRACT, "_source_file")


@query
def written_row_check(s: Stages) -> DataFrame:
    warehouse = tables.Warehouse(s.spark, f"{shared_dir(s.spark)}/check-{uuid.uuid4().hex}")
    return warehouse.write("check", "clean_scrape", s.clean)


@query
def published_run(s: Stages) -> DataFrame:
    """Two runs published in turn, and one begun with the second but published after it."""
    warehouse = tables.Warehouse(s.spark, f"{shared_dir(s.spark)}/runs-{uuid.uuid4().hex}")
    days = {"early": F.col("_file_date") < "2024-01-16", "all": F.lit(True), "late": F.col("_file_date") >= "2024-01-16"}
    refused = 0
    for begun, run in ((["early"], "early"), (["all", "late"], "all"), ([], "late")):
        for name in begun:
            warehouse.begin(name)
            warehouse.write(name, "clean_scrape", s.clean.where(days[name]))
        try:
            warehouse.publish(run)
        except tables.PublicationConflict:
            refused += 1
    seen = tables.Warehouse(s.spark, warehouse.root)
    counts = seen.read("clean_scrape").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(F.lit(seen.current_run()).alias("run"), "row_count", F.lit(refused).alias("refused"))


# --- companies ----------------------------------------------------------------


@query
def entity_ids_of_a_later_run(s: Stages) -> DataFrame:
    """Numbers after all days, with those of a run over the first day kept."""
    signals = resolution.add_signals(s.clean)
    early = resolution.build_entities(signals.where("_file_date = '2024-01-01'"), None)
    early = cut(resolution.extended_registry(early), "entity-ids")
    later = cut(resolution.build_entities(signals, None, early), "companies")
    return resolution.extended_registry(later, early)


@query
def entity_tiers(s: Stages) -> DataFrame:
    return resolution.add_signals(s.clean).select("event_id", "tier", "tier_key")


@query
def signal_counts(s: Stages) -> DataFrame:
    return resolution.signal_counts(s.clean)


@query
def entity_map(s: Stages) -> DataFrame:
    return s.resolution().entity_map


@query
def entity_map_singletons(s: Stages) -> DataFrame:
    return resolution.resolve(s.clean, ("event_id",), pct=100, nameless="singleton").entity_map


@query
def entity_conflicts(s: Stages) -> DataFrame:
    return s.resolution().conflicts


@query
def resolution_summary(s: Stages) -> DataFrame:
    return s.resolution().summary


@query
def top_entities(s: Stages) -> DataFrame:
    return s.resolution().top_entities()


@query
def entity_assignments(s: Stages) -> DataFrame:
    return s.resolution().assignments("event_id")


def _all_names(s: Stages) -> DataFrame:
    """Distinct names of all rows, in order of first appearance."""
    names = s.clean.groupBy(text.normalise_name("company_name").alias("name")).agg(
        F.min("event_id").alias("first_row")
    )
    return common.dense_index(names, ["first_row"], "ord").select("ord", "name")


@query
def fuzzy_name_pairs(s: Stages) -> DataFrame:
    return similar_names.similar_pairs(_all_names(s)).select("later", "earlier", "later_name", "earlier_name")


@query
def fuzzy_name_clusters(s: Stages) -> DataFrame:
    return similar_names.leader_clusters(_all_names(s))


@query
def entity_map_similar_names(s: Stages) -> DataFrame:
    return s.resolution(90).entity_map


@query
def resolution_summary_similar_names(s: Stages) -> DataFrame:
    return s.resolution(90).summary


# --- star schema --------------------------------------------------------------


@query
def dim_date(s: Stages) -> DataFrame:
    return s.star().dim_date.withColumn("full_date", F.col("full_date").cast("string"))


@query
def dim_category(s: Stages) -> DataFrame:
    return s.star().dim_category


@query
def dim_entity(s: Stages) -> DataFrame:
    return s.star().dim_entity


@query
def dim_location(s: Stages) -> DataFrame:
    return s.star().dim_location


@query
def dim_location_of_raw_cities(s: Stages) -> DataFrame:
    return model.dim_location(s.raw, placeholders_as_null=False)


@query
def fact_scrape(s: Stages) -> DataFrame:
    return s.star().fact_scrape.drop("fact_id")


@query
def fact_scrape_by_assignment(s: Stages) -> DataFrame:
    star = s.star()
    rows = s.resolution().assignments()
    linked = model.fact_scrape(
        rows, star.dim_category, s.resolution().entity_map, star.dim_location, link="assignment"
    )
    return linked.drop("fact_id")


@query
def model_row_counts(s: Stages) -> DataFrame:
    return s.star().row_counts()


# --- reports ------------------------------------------------------------------


@query
def q1_daily_unique_phones(s: Stages) -> DataFrame:
    return reports.daily_unique_phones(s.star())


@query
def q2_new_vs_returning(s: Stages) -> DataFrame:
    return reports.new_and_returning(s.star())


@query
def q3_cross_category_entities(s: Stages) -> DataFrame:
    return reports.cross_category_entities(s.star())


@query
def q3_cross_category_known_labels(s: Stages) -> DataFrame:
    return reports.cross_category_entities(s.star(), exclude_unknown=True)


def _first_day(s: Stages) -> model.Star:
    """The star with the companies of the first day only, few of which have all categories."""
    signals = resolution.add_signals(s.clean.where("_file_date = '2024-01-01'"))
    found = resolution.Resolution(signals, None, cut(resolution.build_entities(signals, None), "companies"))
    return dataclasses.replace(s.star(), dim_entity=model.dim_entity(found.entity_map))


@query
def q3_cross_category_of_the_first_day(s: Stages) -> DataFrame:
    return reports.cross_category_entities(_first_day(s))


@query
def q3_known_labels_of_the_first_day(s: Stages) -> DataFrame:
    return reports.cross_category_entities(_first_day(s), exclude_unknown=True)


@query
def q4_top_domains(s: Stages) -> DataFrame:
    return reports.top_sites(s.star().fact_scrape)


@query
def q5_weekly_change(s: Stages) -> DataFrame:
    return reports.weekly_change(s.star())


@query
def weekly_growth_total(s: Stages) -> DataFrame:
    return reports.weekly_growth(s.star())


@query
def pages_top_sites(s: Stages) -> DataFrame:
    return reports.top_sites(s.table("pages"), "url")


@query
def report_files(s: Stages) -> DataFrame:
    folder = f"{shared_dir(s.spark)}/reports-{uuid.uuid4().hex}"
    reports.write_reports(s.star(), folder)
    files = s.spark.read.option("header", True)
    counts = [
        files.csv(f"{folder}/{name}").agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("row_count"))
        for name in reports.REPORTS
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


# --- quality gates ------------------------------------------------------------


@query
def dq_gates(s: Stages) -> DataFrame:
    return quality.gate_report(s.clean, s.star().dim_entity)


@query
def dq_phone_not_null(s: Stages) -> DataFrame:
    return quality.violations(s.clean, "phone_not_null").select("event_id", "phone")


@query
def dq_category_canonical(s: Stages) -> DataFrame:
    return quality.violations(s.clean, "category_canonical").select("event_id", "category")


@query
def dq_duplicate_entities(s: Stages) -> DataFrame:
    return quality.duplicate_entities(s.star().dim_entity)


@query
def dq_phone_ten_digits(s: Stages) -> DataFrame:
    return quality.violations(s.clean, "phone_ten_digits").select("event_id", "phone_clean")


@query
def dq_bad_dates(s: Stages) -> DataFrame:
    return model.bad_dates(s.clean).select("event_id", "scrape_date")


def _spoilt(s: Stages) -> DataFrame:
    """The clean rows with phones that lack a digit, and dates and labels that are none."""
    number = F.col("event_id")
    return s.clean.withColumns(
        {
            "phone_clean": F.when(number % 7 == 0, F.substring("phone_clean", 2, 9)).otherwise(F.col("phone_clean")),
            "scrape_date": F.when(number % 11 == 0, F.concat(F.lit("2024-13-"), number.cast("string"))).otherwise(
                F.col("scrape_date")
            ),
            "category": F.when(number % 13 == 0, F.lower("category")).otherwise(F.col("category")),
        }
    )


@query
def dq_violations_of_spoilt_rows(s: Stages) -> DataFrame:
    """Which row breaks which check."""
    rows = _spoilt(s)
    broken = [
        quality.violations(rows, check).select("event_id", F.lit(check).alias("check_name"))
        for check in ("phone_ten_digits", "category_canonical")
    ]
    return broken[0].unionByName(broken[1]).unionByName(
        model.bad_dates(rows).select("event_id", F.lit("bad_date").alias("check_name"))
    )


@query
def dq_entities_written_twice(s: Stages) -> DataFrame:
    """Each company of a tier below the last is in the dimension once more."""
    dim = s.star().dim_entity
    again = s.resolution().entities.where("tier < 3").select("entity_id")
    return quality.duplicate_entities(dim.unionByName(dim.join(again, "entity_id", "left_semi")))


@query
def fact_ids(s: Stages) -> DataFrame:
    """Rows of the fact and numbers among them: as many."""
    return s.star().fact_scrape.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("fact_id").alias("fact_ids")
    )


# --- days replaced and reports kept up day by day -----------------------------


def _scratch(s: Stages, name: str) -> str:
    return f"{shared_dir(s.spark)}/{name}-{uuid.uuid4().hex}"


@query
def days_replaced(s: Stages) -> DataFrame:
    """The clean rows by day; then the first day is emptied and the last one replaced by its even rows."""
    kept = DailyTable(s.spark, _scratch(s, "daily"))
    kept.load(s.clean)
    first, last = s.clean.agg(F.min("scrape_date"), F.max("scrape_date")).first()
    kept.load(s.clean.where((F.col("scrape_date") == last) & (F.col("event_id") % 2 == 0)), days=[first, last])
    found = kept.read().groupBy(F.col("scrape_date").alias("found_day")).agg(F.sum("event_id").alias("id_sum"))
    check = kept.check()
    return check.join(found, check.day.eqNullSafe(F.col("found_day")), "left").drop("found_day")


@query
def q2_of_new_days(s: Stages) -> DataFrame:
    """The days two to four, each from its own rows and the first days of all entities before it."""
    fact = s.star().fact_scrape
    start = s.star().dim_date.orderBy("date_id").limit(4)
    before, *days = sorted(r.date_id for r in start.select("date_id").toLocalIterator())
    state = increments.FirstSeen(DailyTable(s.spark, _scratch(s, "first-seen"), "first_day"))
    state.build(fact.where(F.col("date_id") <= before))
    lines = [cut(state.advance(day, fact.where(F.col("date_id") == day)), "q2-day") for day in days]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


@query
def weekly_phones_by_sketch(s: Stages) -> DataFrame:
    """Exact weekly counts, and whether merged daily sketches come within 3 % of them."""
    star = s.star()
    sketches = cut(increments.daily_sketches(star.fact_scrape), "sketches")
    weeks = star.dim_date.select("date_id", "week_start")
    estimated = increments.estimated_phones(sketches.join(weeks, "date_id"), "week_start", "category_id")
    estimated = estimated.join(star.dim_category.withColumnRenamed("category_name", "category"), "category_id")
    exact = reports.weekly_change(star).select("week_start", "category", "unique_phones")
    near = F.abs(F.col("estimated_phones") - F.col("unique_phones")) <= 0.03 * F.col("unique_phones")
    return exact.join(estimated, ["week_start", "category"], "left").select(
        "week_start", "category", "unique_phones", F.coalesce(near, F.lit(False)).alias("within_error")
    )
