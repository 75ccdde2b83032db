"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut

SPACE = "[\\x20\\x09-\\x0D]+"  # runs of ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns by exact name under new names, whatever else the table holds.

    Columns are taken by position, so other columns may have any name, also one
    that differs in case only or that an operator uses itself.
    """
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_{names.index(source)}").alias(new) for new, source in wanted.items()])


def whole_row(df: DataFrame) -> DataFrame:
    """All columns in one struct column ``row``; later columns cannot clash with them."""
    names = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])
    return flat.select(F.struct(*[F.col(f"_{i}") for i in range(len(names))]).alias("row"))


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns that :func:`whole_row` packed, under their own names."""
    return df.select(*[F.col("row")[f"_{i}"].alias(name) for i, name in enumerate(names)])


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def crc_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of the id written as text; ids that are null count as empty text."""
    return F.crc32(text_of(F.col(column).cast("string")).cast("binary"))


def join_hot(rows: DataFrame, lookup: DataFrame, key: str, weight: str, spread: str, parts: int = 1000) -> DataFrame:
    """Left join of ``rows`` with ``lookup`` (one line per key) that no key can skew.

    ``weight`` is the number of rows with the key. A key that holds 1/``parts`` of
    all rows or more is hot; there are at most ``parts`` such keys, so their lines
    are broadcast. The other rows are shuffled by key, the hot ones by ``spread``.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    columns = [c for c in lookup.columns if c != key]
    is_hot = (F.col(weight) > 1) & (F.col(weight) * parts >= total)
    hot = lookup.where(is_hot).select(key, F.struct(*columns).alias("_hot"))
    cold = lookup.where(~is_hot).select(F.col(key).cast("string").alias("_cold_key"), F.struct(*columns).alias("_cold"))
    near = rows.join(F.broadcast(hot), key, "left")
    apart = F.concat(F.lit("\u0001"), F.xxhash64(spread).cast("string"))
    own = F.when(F.col("_hot").isNull(), F.col(key).cast("string"))
    keyed = near.withColumn("_cold_key", F.coalesce(own, apart))  # rows without key are spread as well
    found = F.coalesce("_hot", "_cold")
    return keyed.join(cold, "_cold_key", "left").select(*rows.columns, *[found[c].alias(c) for c in columns])


def likely(rows: DataFrame, key: Column, wanted: DataFrame, words: int = 1 << 17) -> DataFrame:
    """``rows`` without most of those whose key is not in the one column of ``wanted``.

    A bitmap of 64 x ``words`` bits is broadcast, whatever the number of keys. All
    rows with a wanted key stay, some others too, so an exact join still follows; it
    shuffles what is left instead of everything.
    """
    return marked_likely(rows, key, wanted, words).where("_likely").select(*rows.columns)


def marked_likely(rows: DataFrame, key: Column, wanted: DataFrame, words: int = 1 << 17) -> DataFrame:
    """``rows`` with ``_likely``: true for each row whose key is in ``wanted``, and for some others."""
    bits = wanted.select(F.xxhash64(F.col(wanted.columns[0])).alias("_h"))

    def word(h: Column) -> Column:
        return F.pmod(h, F.lit(words)).cast("int")

    def bit(h: Column) -> Column:
        return F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(_h, 32), 64) as int))")

    bitmap = bits.groupBy(word(F.col("_h")).alias("_word")).agg(F.bit_or(bit(F.col("_h"))).alias("_bits"))
    hashed = rows.withColumn("_h", F.xxhash64(key)).withColumn("_word", word(F.col("_h")))
    seen = hashed.join(F.broadcast(bitmap), "_word", "left")
    found = F.coalesce(F.col("_bits").bitwiseAND(bit(F.col("_h"))) != 0, F.lit(False))
    return seen.select(*rows.columns, found.alias("_likely"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def arrow_map(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` that hands over batches with rows only."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
        pa.default_memory_pool().release_unused()  # the worker process lives on

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links ``a``, ``b``: (node, component), the smallest node.

    Large-star and small-star steps in turn: every node links its larger neighbours
    to its smallest one, then its smaller ones. A step sees sums of neighbours as
    minima only, so no list of neighbours is gathered; each step is written to the
    shared folder. Nodes without links do not appear.
    """
    links = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .distinct(),
        "links",
    )
    for _ in range(rounds):
        both = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(smallest, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = cut(large.where(F.col("lo") != F.col("hi")).distinct(), "large-star")
        least = large.groupBy(F.col("hi")).agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("m").alias("lo"), F.col("hi")).unionByName(
            small.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        )
        links = cut(small.where(F.col("lo") != F.col("hi")).distinct(), "small-star")
        # done when no node has two smaller neighbours, or a smaller and a larger one
        ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
            links.select(F.col("lo").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
        )
        ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if ends.where("below > 1 or (below > 0 and above > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("lo").alias("node")).distinct().join(
        links.select(F.col("hi").alias("node")), "node", "left_anti"
    )
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
