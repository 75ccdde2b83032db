"""Shards of equal bytes by histogram sort, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import common

KEY_END = 1 << 63  # keys are 63-bit hashes
ROW_BYTES = 8  # what a row costs besides its text


@dataclass
class _Search:
    """Where the splitter of one target can still lie: keys lo..hi of one level."""

    target: float
    lo: int = 0
    hi: int = KEY_END - 1
    below: int = 0  # bytes of all keys under lo
    inside: int = 0  # bytes of the keys lo..hi
    text_key: int | None = None  # set once the search is inside one group of equal texts
    boundary: tuple[int, int] | None = None


def sort_key(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """Hash of the text, then hash of the id: equal texts lie side by side."""
    return (
        F.shiftrightunsigned(F.xxhash64(common.text_of(text_col)), 1),
        F.shiftrightunsigned(F.xxhash64(id_col), 1),
    )


def _histogram(keys: DataFrame, searches: list[_Search], probes: int) -> dict[tuple, list[tuple[int, int, int]]]:
    """Exact bytes between probes, for every open interval: (lo, hi, bytes) in order."""
    spans = sorted({(s.text_key is not None, s.text_key or 0, s.lo, s.hi) for s in searches})
    index, bucket = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, (inner, text_key, lo, hi) in reversed(list(enumerate(spans))):
        step = -(-(hi - lo + 1) // probes)
        column = F.col("id_key") if inner else F.col("text_key")
        here = column.between(F.lit(lo), F.lit(hi))
        if inner:
            here = (F.col("text_key") == F.lit(text_key)) & here
        index = F.when(here, F.lit(i)).otherwise(index)
        bucket = F.when(here, F.expr(f"({'id_key' if inner else 'text_key'} - {lo}L) div {step}L")).otherwise(bucket)
    counted = (
        keys.select(index.alias("i"), bucket.alias("b"), "size")
        .where(F.col("i").isNotNull())
        .groupBy("i", "b")
        .agg(F.sum("size").alias("bytes"))
        .collect()  # at most probes lines per interval
    )
    found: dict[tuple, list[tuple[int, int, int]]] = {span: [] for span in spans}
    for line in sorted(counted, key=lambda r: (r.i, r.b)):
        inner, text_key, lo, hi = spans[line.i]
        step = -(-(hi - lo + 1) // probes)
        start = lo + line.b * step
        found[spans[line.i]].append((start, min(hi, start + step - 1), line.bytes))
    return found


def find_splitters(keys: DataFrame, shards: int, tolerance: float = 0.001, probes: int = 1024) -> list[tuple[int, int]]:
    """Keys at which the shards after the first begin.

    Each round counts, over all partitions, the exact bytes below ``probes``
    candidate boundaries in every interval that may hold a splitter, then goes on
    inside the interval that holds its target. A search ends when a boundary is
    within ``tolerance`` of a shard's size, or at single keys. Only where a group of
    equal texts is larger than that does the search go on among its ids. The driver
    sees ``probes`` counts per splitter and round, whatever the size of the data.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slack = tolerance * total / shards
    searches = [_Search(total * i / shards, inside=total) for i in range(1, shards)]
    while open_ := [s for s in searches if s.boundary is None]:
        found = _histogram(keys, open_, probes)
        for s in open_:
            span = (s.text_key is not None, s.text_key or 0, s.lo, s.hi)
            below = s.below
            for lo, hi, size in found[span]:
                if below + size >= s.target:
                    break
                below += size
            else:  # nothing left above the target: an empty table
                lo, hi, size = s.hi, s.hi, 0
            s.lo, s.hi, s.below, s.inside = lo, hi, below, size
            _settle(s, slack)
    return sorted(s.boundary for s in searches)


def _settle(s: _Search, slack: float) -> None:
    before, after = s.target - s.below, s.below + s.inside - s.target
    near = min(before, after) <= slack
    if not near and s.lo < s.hi:
        return
    if not near and s.text_key is None:  # one group of equal texts: split it by id
        s.text_key, s.lo, s.hi = s.lo, 0, KEY_END - 1
        return
    key = s.lo if before <= after else s.hi + 1
    s.boundary = (key, 0) if s.text_key is None else (s.text_key, key)


def _shard(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the key of a row."""
    reached = F.lit(0)
    for text_key, id_key in splitters:
        if text_key >= KEY_END:
            continue
        at = (F.col("text_key") > F.lit(text_key)) | (
            (F.col("text_key") == F.lit(text_key)) & (F.col("id_key") >= F.lit(min(id_key, KEY_END - 1)))
        )
        reached = reached + at.cast("int")
    return reached


def shard_documents(
    df: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.001,
    task_bytes: int = 16 << 20,
) -> DataFrame:
    """Whole rows dealt to ``shards`` shards of nearly equal bytes, exchanged once.

    Returns ``row`` (a struct of all input columns), ``doc_id``, ``text``, ``size``
    (UTF-8 bytes of the text plus 8), ``shard`` and ``slot``. Rows are ordered by
    (hash of text, hash of id), and a shard is a range of that order, so equal texts
    share a shard unless their group is too large for it. Sizes differ by the
    tolerance plus at most one row at either end. A shard is written by as many tasks as hold ``task_bytes``
    each; a row's slot is its place in its task after the rows of earlier tasks, so
    slots run from 0 without gaps.

    Null texts have no bytes; null ids are ordered like one id. Rows that repeat id
    and text have one key and cannot be parted by a boundary. An empty table gives no
    rows.
    """
    names = df.columns
    text_key, id_key = sort_key()
    rows = common.whole_row(df).select(
        "row",
        F.col("row")[f"_{names.index(id_col)}"].alias("doc_id"),
        F.col("row")[f"_{names.index(text_col)}"].alias("text"),
    )
    keyed = rows.withColumns(
        {
            "text_key": text_key,
            "id_key": id_key,
            "size": F.octet_length(common.text_of("text")).cast("bigint") + F.lit(ROW_BYTES),
        }
    )
    keys = cut(keyed.select("text_key", "id_key", "size"), "keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splitters = find_splitters(keys, shards, tolerance)
    tasks = max(1, -(-total // (shards * task_bytes)))
    # tasks of a shard take its rows by id hash, so a large group is spread as well
    part = (_shard(splitters) * F.lit(tasks) + F.pmod("id_key", F.lit(tasks))).cast("int")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one line per task
        keys.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("shard", F.floor(F.col("part") / tasks).cast("int"))
        .select("part", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    )
    dealt = keyed.withColumn("part", part).repartitionById(shards * tasks, F.col("part"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("text_key", "id_key"))
    return (
        dealt.withColumn("place", place)
        .join(F.broadcast(offsets), "part", "left")
        .select("row", "doc_id", "text", "size", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """The rows of ``df`` with their own columns under ``path/shard=<n>/``, in slot order."""
    names = df.columns
    dealt = shard_documents(df, **options)
    columns = [F.col("row")[f"_{i}"].alias(name) for i, name in enumerate(names)]
    dealt.select(*columns, F.col("shard").alias("shard"), "slot").write.partitionBy("shard").parquet(path)
