"""Removal of long byte strings that occur more than once, by suffix arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common, suffix_groups, winnow

SEEDS = 16  # seeds tried for text ids without collision
CROWD = 4000  # strings at one anchor that are sorted together; more are compared window by window
BUCKET_BYTES = 8 << 20  # strings sorted by one task


def _pieces(rows: DataFrame, window: int) -> DataFrame:
    """Anchored strings of all texts: where they start, how many windows they hold, a digest."""

    def work(batch: pa.RecordBatch):
        data, offsets = common.utf8(batch.column("text"))
        tids = batch.column("tid").to_numpy(zero_copy_only=False)
        lo = 0
        while lo < batch.num_rows:  # whole texts, about a megabyte at a time
            hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + 900_000))), batch.num_rows)
            part = offsets[lo : hi + 1] - offsets[lo]
            own = data[offsets[lo] : offsets[hi]]
            at, length, anchor, key = winnow.anchors(own, part, window)
            text = np.searchsorted(part, at, side="right") - 1
            buffer = own.tobytes()
            ends = (at + length + window - 1).tolist()
            digests = [xxhash.xxh3_128_digest(buffer[a:b]) for a, b in zip(at.tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(digests, pa.binary()),
                    pa.array(tids[lo + text]),
                    pa.array(at - part[text]),
                    pa.array(length.astype(np.int32)),
                    pa.array((anchor - at).astype(np.int32)),
                ],
                ["key", "digest", "tid", "at", "length", "anchor"],
            )
            lo = hi

    return common.arrow_map(rows, work, "key bigint, digest binary, tid bigint, at bigint, length int, anchor int")


_STRINGS = "key bigint, digest binary, weight bigint, kinds bigint, anchor int, string binary"
_RUNS = "key bigint, digest binary, first bigint, length bigint"


def _strings(texts: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """The strings of the chosen pieces, read from their texts."""
    wanted = F.struct("key", "digest", "weight", "kinds", "anchor", "at", "length")
    lists = chosen.groupBy("tid").agg(F.collect_list(wanted).alias("wanted"))  # at most one per byte of a text

    def work(batch: pa.RecordBatch):
        data, offsets = common.utf8(batch.column("text"))
        for i, wanted in enumerate(batch.column("wanted")):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            made = [
                (w["key"], w["digest"], w["weight"], w["kinds"], w["anchor"], text[w["at"] : w["at"] + w["length"] + window - 1])
                for w in wanted.as_py()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made), (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["key", "digest", "weight", "kinds", "anchor", "string"],
            )

    return common.arrow_map(texts.join(lists, "tid").select("text", "wanted"), work, _STRINGS)


def _sorted_runs(strings: DataFrame, buckets: int, window: int) -> DataFrame:
    """Runs of repeated windows, by one suffix array for the strings at each anchor."""
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("digest", "ascending")])
        columns = [table.column(c).to_pylist() for c in ("key", "digest", "string", "anchor", "weight")]
        found: list[tuple[int, bytes, int, int]] = []

        def close(group: list[tuple]):
            runs = suffix_groups.repeats_at_anchor(
                [g[2] for g in group], [g[3] for g in group], [g[4] for g in group], window
            )
            found.extend((g[0], g[1], first, length) for g, own in zip(group, runs) for first, length in own)

        group: list[tuple] = []
        for line in zip(*columns):
            if group and group[-1][0] != line[0]:
                close(group)
                group = []
            if not group or group[-1][1] != line[1]:  # the same string from a repeated row comes once
                group.append(line)
        if group:
            close(group)
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
        names = ["key", "digest", "first", "length"]
        return pa.table([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], names=names)

    return strings.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(work, _RUNS)


def _compared_runs(strings: DataFrame, window: int) -> DataFrame:
    """The same for anchors with more than CROWD strings, whose windows are dealt out by hash."""

    def windows(batch: pa.RecordBatch):
        for key, digest, weight, string in zip(*[batch.column(c).to_pylist() for c in ("key", "digest", "weight", "string")]):
            places = range(len(string) - window + 1)
            hashes = [xxhash.xxh3_128_digest(string[p : p + window]) for p in places]
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * n, pa.int64()), pa.array([digest] * n, pa.binary()), pa.array([weight] * n, pa.int64()),
                 pa.array(list(places), pa.int64()), pa.array(hashes, pa.binary())],
                ["key", "digest", "weight", "first", "hash"],
            )

    dealt = strings.dropDuplicates(["key", "digest"])
    dealt = common.arrow_map(dealt, windows, "key bigint, digest binary, weight bigint, first bigint, hash binary")
    dealt = cut(dealt, "windows")
    common_ = dealt.groupBy("hash").agg(F.sum("weight").alias("weight")).where("weight > 1").select("hash")
    return dealt.join(common_, "hash", "left_semi").select("key", "digest", "first", F.lit(1).cast("bigint").alias("length"))


def find_repeats(df: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256`` for each row.

    The whole text is taken as UTF-8 bytes. A byte is removed when a string of
    ``window`` bytes that covers it also starts anywhere else, in the same row or in
    another; strings may overlap and never cross rows. ``spans`` holds the maximal
    removed runs as (start, end), ``kept_sha256`` is the lowercase hex digest of the
    bytes that are left, joined.

    Every window has an anchor that depends on its bytes alone, so equal windows
    meet under one anchor hash. Windows of a text with the same anchor form one
    string. Strings are merged by content before they are shuffled; where all
    strings at an anchor are equal they repeat as a whole. Where they differ, a suffix
    array, built by linear grouping, tells which windows repeat. An anchor with more
    than CROWD different strings is not brought into one task: its windows are dealt
    out by a 128-bit hash. No window is left out either way.

    Null texts count as empty; texts shorter than ``window`` keep all bytes. Rows with
    equal texts repeat each other and get equal results, also without id. An empty
    table gives no rows; other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text"))
    for seed in range(SEEDS):
        tid = F.xxhash64("text", F.lit(seed)).alias("tid")
        facts = rows.select("doc_id", tid, F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes"))
        facts = cut(facts, "facts")
        texts = facts.groupBy("tid").agg(
            F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.min("sha").alias("a"), F.max("sha").alias("b")
        )
        texts = cut(texts, "texts")
        if texts.where("a <> b").isEmpty():
            break
    else:
        raise RuntimeError(f"texts collide under all of {SEEDS} seeds")

    long = rows.where(F.octet_length("text") >= window).select("doc_id", tid, "text")
    pieces = cut(_pieces(long.select("tid", "text"), window), "pieces")
    shared = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    repeated = pieces.join(shared, "key", "left_semi")
    repeated = cut(repeated.groupBy("key", "digest", "tid", "at", "length", "anchor").agg(F.count(F.lit(1)).alias("n")), "repeated")
    strings = repeated.groupBy("key", "digest").agg(
        F.sum("n").alias("weight"), F.min(F.struct("tid", "at", "length", "anchor")).alias("rep")
    )
    strings = cut(strings, "strings")
    kinds = strings.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    strings = cut(strings.join(kinds, "key").select("key", "digest", "weight", "kinds", "rep.*"), "kinds")

    touched = repeated.select("tid").distinct().join(texts, "tid").select("tid", "first_doc")
    same_row = (long["tid"] == touched["tid"]) & long["doc_id"].eqNullSafe(touched["first_doc"])
    bodies = cut(long.join(touched, same_row).select(touched["tid"], "text"), "bodies")

    mixed = strings.where("kinds > 1")
    size, crowded = mixed.agg(F.sum(F.col("length") + F.lit(window)), F.count_if(F.col("kinds") > CROWD)).first()
    alike = strings.where("kinds = 1").select(
        "key", "digest", F.lit(0).cast("bigint").alias("first"), F.col("length").cast("bigint").alias("length")
    )
    runs = alike
    if size:
        sorted_ = _strings(bodies, mixed.where(F.col("kinds") <= CROWD), window)
        runs = runs.unionByName(_sorted_runs(sorted_, max(1, -(-size // BUCKET_BYTES)), window))
        if crowded:
            runs = runs.unionByName(_compared_runs(_strings(bodies, mixed.where(F.col("kinds") > CROWD), window), window))
    runs = cut(runs, "runs")
    found = repeated.join(runs.withColumnRenamed("length", "windows"), ["key", "digest"])
    lists = found.groupBy("tid").agg(F.collect_list(F.struct((F.col("at") + F.col("first")).alias("start"), "windows")).alias("found"))
    removed = _removed(bodies.join(lists, "tid"), window).dropDuplicates(["tid"])
    results = cut(removed.join(texts.select("tid", "copies"), "tid"), "removed")
    every = common.join_hot(facts, results, "tid", "copies", "doc_id")
    return every.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def covered(starts: np.ndarray, windows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under any of the windows: starts and ends."""
    order = np.argsort(starts, kind="stable")
    lo = starts[order]
    hi = np.maximum.accumulate(lo + windows[order] + window - 1)
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    return lo[new], hi[np.concatenate([new[1:] - 1, [len(hi) - 1]])]


def _removed(texts: DataFrame, window: int) -> DataFrame:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def work(batch: pa.RecordBatch):
        data, offsets = common.utf8(batch.column("text"))
        removed, spans, digests = [], [], []
        for i, found in enumerate(batch.column("found")):
            lines = found.values
            lo, hi = covered(lines.field("start").to_numpy(), lines.field("windows").to_numpy(), window)
            text = data[offsets[i] : offsets[i + 1]]
            digest, done = hashlib.sha256(), 0
            for a, b in zip(lo.tolist(), hi.tolist()):
                digest.update(text[done:a].tobytes())
                done = b
            digest.update(text[done:].tobytes())
            removed.append(int((hi - lo).sum()))
            spans.append([{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist())])
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("tid"), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(digests, pa.string())],
            ["tid", "n_removed", "spans", "kept_sha256"],
        )

    schema = "tid bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    return common.arrow_map(texts.select("tid", "text", "found"), work, schema)
