"""Reports of a new day from that day and a small state, without the history of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.daily_table import DailyTable
from .star import NO_MATCH


class FirstSeen:
    """First day of every entity, kept by that day.

    A day adds the entities that no earlier day holds; nothing else is written. Days
    are applied in order: a day that is older than the last one takes that day and the
    later ones back first (:meth:`take_back`).
    """

    def __init__(self, table: DailyTable):
        if table.day != "first_day":
            raise ValueError("the state is kept by first_day")
        self.table = table

    def build(self, fact: DataFrame) -> None:
        """The state after all days of ``fact``; replaces what is there."""
        self.take_back(None)
        days = fact.where(F.col("entity_id") != NO_MATCH).groupBy("entity_id")
        self.table.load(days.agg(F.min("date_id").alias("first_day")))

    def take_back(self, day: str | None) -> None:
        """Forget ``day`` and all later ones; without a day, everything."""
        state = self.table.read()
        if state is not None:
            gone = state.select("first_day").distinct()
            gone = [r[0] for r in (gone if day is None else gone.where(F.col("first_day") >= day)).toLocalIterator()]
            if gone:
                self.table.load(state.limit(0), days=gone)

    def advance(self, day: str, rows: DataFrame) -> DataFrame:
        """Take in the rows of one day; ``scrape_date, new_entities, returning_entities`` of that day.

        The same day may be given again: its entities are then those of the new rows.
        A day without entities has no line.
        """
        state = self.table.read()
        if state is not None and not state.where(F.col("first_day") > day).isEmpty():
            raise ValueError(f"the state holds days after {day}: take them back first")
        found = rows.where(F.col("entity_id") != NO_MATCH).select("entity_id").distinct()
        new = found
        if state is not None:
            new = found.join(state.where(F.col("first_day") < day).select("entity_id"), "entity_id", "left_anti")
        self.table.load(new.withColumn("first_day", F.lit(day)), days=[day])
        first = self.table.read().where(F.col("first_day") == day).select("entity_id", F.lit(1).alias("is_new"))
        both = found.select("entity_id", F.lit(0).alias("is_new")).unionByName(first)  # a new entity is in both
        counts = both.agg(F.sum("is_new").alias("new_entities"), F.count_if(F.col("is_new") == 0).alias("all_entities"))
        return counts.where("all_entities > 0").select(
            F.lit(day).alias("scrape_date"),
            "new_entities",
            (F.col("all_entities") - F.col("new_entities")).alias("returning_entities"),
        )


def daily_sketches(fact: DataFrame, lg_k: int = 14) -> DataFrame:
    """``date_id, category_id, phones``: a HyperLogLog sketch of the phones of each day and category.

    A sketch has at most 2^``lg_k`` registers; its relative standard error is about
    1.04 / 2^(``lg_k`` / 2), 0.8 % by default. Sketches of days are kept and merged, so
    weeks and totals never read the fact again.
    """
    keyed = fact.where(F.col("category_id").isNotNull()).groupBy("date_id", "category_id")
    return keyed.agg(F.hll_sketch_agg("phone_clean", F.lit(lg_k)).alias("phones"))


def estimated_phones(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct phones by ``keys``, from sketches that are merged."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("phones")).alias("estimated_phones"))
