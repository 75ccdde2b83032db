"""Reports over the star schema.

Distinct counts are two-step aggregations (by key and value, then by key), so a
hot day, week or category is pre-aggregated before it is shuffled. Names are
looked up after aggregating, on the few result rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import contact, dates
from ..operators import common
from .star import NO_MATCH, Star


def daily_unique_phones(star: Star) -> DataFrame:
    """Unique phones per day and category."""
    counts = (
        star.fact_scrape.where(F.col("category_id").isNotNull())
        .groupBy("date_id", "category_id")
        .agg(F.count_distinct("phone_clean").alias("unique_phones"))
    )
    return (
        counts.join(star.dim_category, "category_id")
        .select(
            F.col("date_id").alias("scrape_date"),
            F.col("category_name").alias("category"),
            "unique_phones",
        )
        .orderBy("scrape_date", "category")
    )


def new_and_returning(star: Star) -> DataFrame:
    """Entities per day, split into first-time and returning ones.

    The window runs over distinct (day, entity) pairs: at most one row per day
    for any entity, however many scrape rows it has.
    """
    days = star.fact_scrape.where(F.col("entity_id") != NO_MATCH).select("date_id", "entity_id").distinct()
    first = F.min("date_id").over(Window.partitionBy("entity_id"))
    return (
        days.withColumn("first_seen", first)
        .groupBy(F.col("date_id").alias("scrape_date"))
        .agg(
            F.count_if(F.col("date_id") == F.col("first_seen")).alias("new_entities"),
            F.count_if(F.col("date_id") > F.col("first_seen")).alias("returning_entities"),
        )
        .orderBy("scrape_date")
    )


def cross_category_entities(star: Star, exclude_unknown: bool = False) -> DataFrame:
    """Entities listed in more than one category."""
    labels = F.split("all_categories", r"\|")
    if exclude_unknown:
        several = F.size(F.array_remove(labels, contact.UNKNOWN_CATEGORY)) > 1
    else:
        several = F.col("all_categories").contains("|")
    return (
        star.dim_entity.where(several)
        .select(
            F.col("canonical_name").alias("entity_name"),
            F.col("all_categories").alias("categories"),
            "first_seen",
        )
        .orderBy(F.asc_nulls_last("entity_name"))
    )


def top_sites(rows: DataFrame, website: str = "website_clean", k: int = 10) -> DataFrame:
    """Sites with most rows; equal counts are ordered by name."""
    counts = (
        rows.where(F.col(website).isNotNull())
        .groupBy(contact.site_key(website).alias("domain"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return common.top_rows(counts, "row_count", k, "domain")


def _weekly(star: Star, *keys: str) -> DataFrame:
    """Unique phones per week and keys, over all rows of the fact."""
    weeks = star.dim_date.select("date_id", "week_start")
    return (
        star.fact_scrape.join(weeks, "date_id")
        .groupBy("week_start", *keys)
        .agg(F.count_distinct("phone_clean").alias("unique_phones"))
    )


def weekly_change(star: Star, calendar: bool = False) -> DataFrame:
    """Unique phones per week and category and their change in percent.

    The change is against the last week present; with ``calendar`` only against
    the week exactly seven days before.
    """
    weekly = _weekly(star, "category_id").join(star.dim_category, "category_id")
    by_week = Window.partitionBy("category_id").orderBy("week_start")
    before = F.lag("unique_phones").over(by_week)
    if calendar:
        gap = F.datediff(F.col("week_start").cast("date"), F.lag("week_start").over(by_week).cast("date"))
        before = F.when(gap == 7, before)
    return (
        weekly.withColumn("before", before)
        .select(
            "week_start",
            F.col("category_name").alias("category"),
            "unique_phones",
            dates.percent_change("unique_phones", "before").alias("pct_change"),
        )
        .orderBy("week_start", "category")
    )


def weekly_growth(star: Star) -> DataFrame:
    """Unique phones per week over all categories and their change in percent."""
    before = F.lag("unique_phones").over(Window.orderBy("week_start"))  # one row per week
    return (
        _weekly(star)
        .withColumn("before", before)
        .select(
            "week_start",
            "unique_phones",
            dates.percent_change("unique_phones", "before").alias("pct_change"),
        )
        .orderBy("week_start")
    )


# Report names and order of the published result files.
REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "q1_daily_unique_phones": daily_unique_phones,
    "q2_new_vs_returning": new_and_returning,
    "q3_cross_category_entities": cross_category_entities,
    "q4_top_domains": lambda star: top_sites(star.fact_scrape),
    "q5_weekly_change": weekly_change,
}


def write_reports(
    star: Star, folder: str, reports: dict[str, Callable[[Star], DataFrame]] = REPORTS
) -> dict[str, int]:
    """Write each report as CSV with a header; rows written per report.

    Reports are aggregates of a few rows per day, week or category and go to
    one file each. The list of cross-category entities grows with the entities
    and is written by as many tasks as it takes.
    """
    written = {}
    for name, build in reports.items():
        seen = Observation()
        out = build(star).observe(seen, F.count(F.lit(1)).alias("rows"))
        if name != "q3_cross_category_entities":
            out = out.coalesce(1)
        out.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
        written[name] = seen.get["rows"]
    return written
