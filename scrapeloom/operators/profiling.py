"""Profiles of the raw and the clean table. Each is one scan with map-side
partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contact, dates, text
from . import common

# Columns of the blank profile.
BLANK_COLUMNS = (
    "scrape_date", "category", "company_name", "phone", "email", "website",
    "employee_count", "city", "country", "source_url",
)


def table_size(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns")
    )


def null_profile(df: DataFrame, columns: list[str] | None = None, only_hits: bool = True) -> DataFrame:
    """NULLs per column with their share in percent."""
    columns = columns or df.columns
    counts = common.count_where(df, {c: F.col(c).isNull() for c in columns})
    return _share(counts.where("hits > 0") if only_hits else counts, "nulls")


def blank_profile(df: DataFrame, columns: tuple[str, ...] = BLANK_COLUMNS) -> DataFrame:
    """NULL or blank cells per column with their share in percent."""
    present = [c for c in columns if c in df.columns]
    return _share(common.count_where(df, {c: text.is_blank(c) for c in present}), "blanks")


def null_text_scan(df: DataFrame, columns: tuple[str, ...] = BLANK_COLUMNS) -> DataFrame:
    """Cells that hold a null-like text instead of NULL, per column."""
    present = [c for c in columns if c in df.columns]
    hits = {c: F.col(c).isNotNull() & text.is_null_like(c) for c in present}
    return _share(common.count_where(df, hits), "null_texts")


def _share(counts: DataFrame, name: str) -> DataFrame:
    return counts.select(
        F.col("name").alias("column_name"),
        F.col("hits").alias(name),
        dates.percent_share("hits", "total_rows", 1).alias("pct"),
    )


def rows_per_day(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("scrape_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.asc_nulls_last("scrape_date"))
    )


def category_share(df: DataFrame) -> DataFrame:
    """Rows and share in percent per raw category label."""
    counts = df.groupBy("category").agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return (
        counts.select("category", "row_count", dates.percent_share("row_count", total, 1).alias("pct"))
        .orderBy(F.desc("row_count"), F.asc_nulls_last("category"))
    )


def top_countries(df: DataFrame, k: int = 10) -> DataFrame:
    counts = (
        df.where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return common.top_rows(counts, "row_count", k, "country")


def schema_change_trace(df: DataFrame, column: str = "source_url") -> DataFrame:
    """Per day: rows, and rows in which the late column is filled."""
    return (
        df.groupBy("scrape_date")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count(column).alias(f"rows_with_{column}"),
        )
        .orderBy(F.asc_nulls_last("scrape_date"))
    )


def phone_digit_lengths(raw: DataFrame) -> DataFrame:
    """Rows per digit count and leading digit of phones without extension."""
    digits = contact.phone_digits("phone")
    return (
        raw.where(~text.is_null_like("phone"))
        .select(digits.alias("digits"))
        .groupBy(
            F.length("digits").cast("bigint").alias("n_digits"),
            F.substring("digits", 1, 1).alias("leading_digit"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def category_variants(raw: DataFrame) -> DataFrame:
    """Raw labels with their canonical label, first day, files and rows."""
    return (
        raw.where(F.col("category").isNotNull())
        .groupBy(
            F.col("category").alias("raw_category"),
            contact.clean_category("category").alias("canonical"),
        )
        .agg(
            dates.earliest("scrape_date").alias("first_seen"),
            F.count_distinct("_source_file").alias("n_files"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def malformed_emails(clean: DataFrame) -> DataFrame:
    """Rows per e-mail flag with the first day of each."""
    return clean.groupBy("email_clean_flag").agg(
        F.count(F.lit(1)).alias("row_count"), dates.earliest("scrape_date").alias("first_seen")
    )


def rolling_volume(df: DataFrame, days: int = 7, band: float = 0.20) -> DataFrame:
    """Daily rows against the mean of the ``days`` calendar days before.

    Days between the first and the last that have no rows count as 0. The window
    runs over one row per day, so its single task stays tiny.
    """
    present = (
        df.select(dates.iso_date("scrape_date").alias("day"))
        .where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    span = present.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    daily = calendar.join(present, "day", "left").fillna(0, ["row_count"])
    before = Window.orderBy("day").rowsBetween(-days, -1)
    mean = F.avg("row_count").over(before)
    return daily.select(
        F.col("day").cast("string").alias("scrape_date"),
        "row_count",
        F.round(mean, 2).alias("rolling_avg"),
        F.coalesce(F.abs(F.col("row_count") - mean) <= F.lit(band) * mean, F.lit(True)).alias("within_band"),
    )


def phone_stability(clean: DataFrame, key: str = "host") -> DataFrame:
    """Companies (same host, or same name) seen with more than one phone.

    Rows are first reduced to one per company and phone, so that a company
    with very many rows costs no more than one with few.
    """
    company = {
        "host": contact.site_host("website_clean"),
        "name": F.nullif(text.normalise_name("company_name"), F.lit("")),
    }[key]
    seen = (
        clean.select(company.alias("company"), "phone_clean", dates.iso_date("scrape_date").alias("day"))
        .where("company is not null and phone_clean is not null")
        .groupBy("company", "phone_clean")
        .agg(
            F.min("day").alias("first_seen"),
            F.max("day").alias("last_seen"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    return (
        seen.groupBy("company")
        .agg(
            F.count(F.lit(1)).alias("unique_phones"),
            F.min("first_seen").cast("string").alias("first_seen"),
            F.max("last_seen").cast("string").alias("last_seen"),
            F.sum("rows").alias("row_count"),
        )
        .where("unique_phones > 1")
    )
