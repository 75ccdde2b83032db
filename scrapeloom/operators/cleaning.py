"""Cleaning stage: narrow, one pass, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contact, text
from . import common

# The text columns that cleaning trims and null-normalises.
TEXT_COLUMNS = (
    "scrape_date", "category", "company_name", "phone", "email", "website",
    "employee_count", "city", "country", "scraped_at", "source_url",
)
# A row is a stray header line if one of these holds its own name.
HEADER_COLUMNS = ("category", "company_name", "scrape_date")
# The columns that cleaning adds, in order.
CLEAN_COLUMNS = (
    "phone_clean", "phone_clean_flag", "email_clean", "email_clean_flag", "website_clean",
)
# Columns of the null summary after cleaning.
SUMMARY_COLUMNS = ("phone_clean", "email_clean", "website_clean", "city", "employee_count")


def is_header_row(columns: tuple[str, ...] = HEADER_COLUMNS) -> Column:
    return reduce(or_, [F.col(c).eqNullSafe(c) for c in columns])


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Drop header lines that arrived as data; rows with NULLs stay."""
    return df.where(~is_header_row())


def tidy_text(df: DataFrame) -> DataFrame:
    """Trim the text columns and turn null-like texts into NULL."""
    return df.withColumns({c: text.tidy(c) for c in TEXT_COLUMNS if c in df.columns})


def add_clean_columns(
    df: DataFrame,
    labels: Mapping[str, str] = contact.CATEGORY_LABELS,
    extended_extensions: bool = False,
) -> DataFrame:
    return df.withColumns(
        {
            "category": contact.clean_category("category", labels, tidied=True),
            "phone_clean": contact.clean_phone("phone", extended_extensions),
            "email_clean": contact.clean_email("email", tidied=True),
            "website_clean": contact.clean_website("website", tidied=True),
        }
    ).withColumns(
        {
            "phone_clean_flag": contact.phone_flag("phone", "phone_clean", tidied=True),
            "email_clean_flag": contact.email_flag("email", tidied=True),
        }
    )


def clean_scrape(
    raw: DataFrame,
    labels: Mapping[str, str] = contact.CATEGORY_LABELS,
    extended_extensions: bool = False,
) -> DataFrame:
    """raw_scrape to clean_scrape."""
    clean = add_clean_columns(tidy_text(drop_header_rows(raw)), labels, extended_extensions)
    return clean.select(*text.quoted([*raw.columns, *CLEAN_COLUMNS]))


def value_distribution(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows per value of each column in one scan: (column_name, value, row_count)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell.value").isNotNull())
        .groupBy("cell.column_name", "cell.value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def cleaning_summary(clean: DataFrame) -> DataFrame:
    """Label and flag distributions and nulls after cleaning, in one table:
    (section, column_name, value, row_count)."""
    values = value_distribution(clean, ("category", "phone_clean_flag", "email_clean_flag"))
    nulls = common.count_where(clean, {c: F.col(c).isNull() for c in SUMMARY_COLUMNS})
    return values.select(F.lit("values").alias("section"), "column_name", "value", "row_count").unionByName(
        nulls.select(
            F.lit("nulls").alias("section"),
            F.col("name").alias("column_name"),
            F.lit(None).cast("string").alias("value"),
            F.col("hits").alias("row_count"),
        )
    )


def category_change(raw: DataFrame) -> DataFrame:
    """Label counts before and after cleaning."""
    rows = tidy_text(drop_header_rows(raw)).select(
        F.col("category").alias("raw_category"),
        contact.clean_category("category").alias("category"),
    )
    return rows.groupBy("raw_category", "category").agg(F.count(F.lit(1)).alias("row_count"))


def phone_samples(clean: DataFrame, flag: str, k: int = 10) -> DataFrame:
    """Phones with the given flag, before and after cleaning."""
    return (
        clean.where(F.col("phone_clean_flag") == flag)
        .select("phone", "phone_clean")
        .distinct()
        .orderBy("phone")
        .limit(k)
    )
