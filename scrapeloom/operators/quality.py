"""Quality gates over the clean table and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import contact
from . import common
from .profiling import rolling_volume


def row_checks() -> dict:
    """Named conditions that a row must not meet."""
    labels = contact.canonical_labels()
    return {
        "phone_not_null": F.col("phone_clean").isNull(),
        "category_canonical": ~F.coalesce(F.col("category").isin(*labels), F.lit(False)),
        "phone_ten_digits": F.col("phone_clean").isNotNull()
        & ~F.col("phone_clean").rlike("^[0-9]{10}$"),
    }


def violations(clean: DataFrame, check: str) -> DataFrame:
    """The rows that break one of :func:`row_checks`."""
    return clean.where(row_checks()[check])


def duplicate_entities(dim_entity: DataFrame) -> DataFrame:
    """Entity ids that occur more than once."""
    return dim_entity.groupBy("entity_id").agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def gate_report(clean: DataFrame, dim_entity: DataFrame) -> DataFrame:
    """All gates: (check_name, failures, passed)."""
    rows = common.count_where(clean, row_checks()).select(
        F.col("name").alias("check_name"), F.col("hits").alias("failures")
    )
    ids = duplicate_entities(dim_entity).agg(F.count(F.lit(1)).alias("failures"))
    days = rolling_volume(clean).agg(F.count_if(~F.col("within_band")).alias("failures"))
    report = rows.unionByName(
        ids.select(F.lit("entity_id_unique").alias("check_name"), "failures")
    ).unionByName(days.select(F.lit("daily_volume_in_band").alias("check_name"), "failures"))
    return report.withColumn("passed", F.col("failures") == 0)


def reconcile(name: str, written: DataFrame, expected_rows: int) -> DataFrame:
    """Rows found in a written table against the rows handed to the writer."""
    return written.agg(F.count(F.lit(1)).alias("rows_written")).select(
        F.lit(name).alias("table_name"),
        F.lit(expected_rows).cast("bigint").alias("rows_expected"),
        "rows_written",
        (F.col("rows_written") == expected_rows).alias("matches"),
    )
