"""Small operators used across the stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number rows 1..n by ``order`` (a unique key) without a one-task window.

    The rows are range-sorted and written once, each with its place inside its
    sort task; a row's number is that place plus the size of all earlier tasks.
    The joined side has one row per sort task, never more than the session's
    shuffle partitions.
    """
    place = F.monotonically_increasing_id()
    ranked = cut(df.orderBy(*order).withColumn("_place", place), "sorted")
    task = F.shiftright("_place", 33)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy(task.alias("_task"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranked.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    return numbered.select(
        (F.col("_before") + within + 1).cast("bigint").alias(name), *df.columns
    )


def top_rows(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``ties`` decide between equals."""
    return df.orderBy(F.desc(by), *[F.asc_nulls_last(t) for t in ties]).limit(k)


def distinct_sample(df: DataFrame, column: str, k: int) -> DataFrame:
    """The first ``k`` distinct non-null values in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(k)


def preview(df: DataFrame, k: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(k)


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column with its SQL type and the rows in which it is filled."""
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    filled = count_where(df, {c: F.col(c).isNotNull() for c in df.columns})
    return filled.select(
        F.col("name").alias("column_name"),
        types[F.col("name")].alias("column_type"),
        F.col("hits").alias("filled_rows"),
    )


def count_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One scan: rows meeting each named condition, as (name, hits, total_rows)."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(conditions.values())],
    )
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(f"_{i}").alias("hits"))
            for i, name in enumerate(conditions)
        ]
    )
    return totals.select(F.explode(entries).alias("e"), "total_rows").select(
        "e.name", "e.hits", "total_rows"
    )
