"""Equal shares of the pairs that the blocks of a join make.

Rows meet when they share a block. Blocks differ in size by any factor, so dealing
blocks to tasks leaves one task with the largest of them. Here the work of all
blocks is numbered through, as in "Load Balancing for MapReduce-based Entity
Resolution" (Kolb, Thor & Rahm, ICDE 2012), and each task gets an equal range of these
numbers. A block that spans several ranges is cut into a grid of tiles, each of
about one range at most; its rows go to the tiles of their row or column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

KEYS = ("_range", "block", "_tile")


class PairRanges:
    """The pairs (left, right) of rows with one ``block``, dealt evenly to ``tasks`` ranges.

    ``left`` and ``right`` need the columns ``block`` and ``ord``; rows of one ``ord`` in
    a block stay together. The work of a block is the pairs it makes and the rows it
    reads. ``pairs`` and ``rows`` are the totals.
    """

    def __init__(self, left: DataFrame, right: DataFrame, tasks: int | None = None):
        spark = left.sparkSession
        self.left, self.right = left, right
        self.tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        counts = [
            side.groupBy("block").agg(F.count(F.lit(1)).alias(name)) for side, name in ((left, "a"), (right, "b"))
        ]
        work = F.col("a") * F.col("b") + F.col("a") + F.col("b")
        sizes = counts[0].join(counts[1], "block").withColumn("work", work)
        place = F.monotonically_increasing_id()
        self.sizes = cut(sizes.orderBy("block").withColumn("_place", place), "block-sizes")
        totals = self.sizes.agg(F.sum(F.col("a") * F.col("b")), F.sum(F.col("a") + F.col("b")), F.sum("work"))
        self.pairs, self.rows, self.work = (x or 0 for x in totals.first())
        self.width = max(1, -(-self.work // self.tasks))

    def _tiles(self) -> DataFrame:
        """``block, down, across, start, step``: the grid of each block and the numbers of its tiles."""
        ranges = F.col("work") / F.lit(self.width)
        down = F.least("a", F.greatest(F.lit(1), F.ceil(F.sqrt(ranges))))
        grid = self.sizes.withColumn("down", down.cast("int"))
        across = F.least("b", F.greatest(F.lit(1), F.ceil(ranges / F.col("down"))))
        grid = grid.withColumn("across", across.cast("int")).withColumn("_task", F.shiftright("_place", 33))
        # a running sum within each sorted part, and the parts before it: one row per part
        earlier = Window.partitionBy("_task").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        parts = self.sizes.groupBy(F.shiftright("_place", 33).alias("_task")).agg(F.sum("work").alias("_work"))
        parts = parts.select("_task", F.coalesce(F.sum("_work").over(before), F.lit(0)).alias("_before"))
        within = F.coalesce(F.sum("work").over(earlier), F.lit(0))
        numbered = grid.withColumn("_within", within).join(F.broadcast(parts), "_task")
        return numbered.select(
            "block",
            "down",
            "across",
            (F.col("_before") + F.col("_within")).alias("start"),
            (F.col("work") / (F.col("down") * F.col("across"))).alias("step"),
        )

    def sides(self) -> tuple[DataFrame, DataFrame]:
        """Both sides with ``_range`` and ``_tile``: any two rows of a block share exactly one tile.

        Rows whose block has no row on the other side are left out.
        """
        tiles = cut(self._tiles(), "tiles")

        def dealt(side: DataFrame, own: str, other: str, tile) -> DataFrame:
            slice_ = F.pmod(F.xxhash64("ord"), F.col(own)).cast("int")
            rows = side.join(tiles, "block").withColumn("_own", slice_)
            rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            rows = rows.withColumn("_tile", tile)
            middle = F.col("start") + (F.col("_tile") + 0.5) * F.col("step")
            place = F.least(F.lit(self.tasks - 1), F.floor(middle / F.lit(self.width))).cast("int")
            return rows.select(*side.columns, "_tile", place.alias("_range"))

        return (
            dealt(self.left, "down", "across", F.col("_own") * F.col("across") + F.col("_other")),
            dealt(self.right, "across", "down", F.col("_other") * F.col("across") + F.col("_own")),
        )

    def meet(self, condition: Column | str) -> DataFrame:
        """All pairs that fulfil the condition, with the columns of both sides as ``<name>_a`` and ``<name>_b``.

        Each range goes to the task of its number, so the shares stay equal.
        """
        left, right = self.sides()
        left, right = (
            side.select(*KEYS, *[F.col(c).alias(f"{c}_{x}") for c in side.columns if c not in KEYS]).repartitionById(
                self.tasks, "_range"
            )
            for side, x in ((left, "a"), (right, "b"))
        )
        return left.join(right, list(KEYS)).where(condition).drop(*KEYS)
