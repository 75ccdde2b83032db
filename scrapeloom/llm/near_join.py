"""N-gram Jaccard join by rare-first prefixes, verified pair by pair, to classes of linked documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.pair_ranges import PairRanges
from ..session import cut
from . import common

ROW = ("doc_id", "absent", "value", "digest")  # the last three tell rows of different id or text apart
SKETCH = 1 << 17  # counters of the frequency sketch
STARS, ROUNDS = 2, 3  # members of a bucket that all others meet first, and how often
FOLDED = 4  # 64-bit words of a node's bitmap of n-grams as it is in buckets, and the fewest of a whole one
HELD = 1 << 20  # hashes counted together
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Distinct 64-bit hashes, sorted, of the word n-grams of a text in lower case (A-Z).

    Fewer words than ``words`` make one n-gram; no words make none.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    with np.errstate(over="ignore"):
        mixed = np.full(len(parts) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ hashes[k : len(parts) - width + 1 + k]) * _ODD[k % len(_ODD)]
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@dataclass(frozen=True)
class Threshold:
    """Similarity of at least ``percent`` / 100, in whole numbers."""

    percent: int

    def prefix(self, n: int) -> int:
        """N-grams of a set of ``n`` of which a linked set shares one."""
        return n - -(-self.percent * n // 100) + 1

    def linked(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (a + b - both)

    def least_shared(self, a, b):
        """Smallest overlap of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def few_apart(self, apart, a, b):
        """Whether sets of these sizes may link of which at least ``apart`` n-grams are in one only."""
        return apart * (100 + self.percent) <= (a + b) * (100 - self.percent)

    def can_link(self, a: str, b: str, at_a: str, at_b: str) -> Column:
        """Length and positional filter for sets of sizes a, b that share the n-grams at these places."""
        size_a, size_b = F.col(a).cast("bigint"), F.col(b).cast("bigint")
        lengths = F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * self.percent
        reach = 1 + F.least(size_a - F.col(at_a) - 1, size_b - F.col(at_b) - 1)
        return lengths & (reach * (100 + self.percent) >= (size_a + size_b) * self.percent)


def _hash_bucket(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(40)).astype(np.int64) & (SKETCH - 1)


def _bitmap(values: np.ndarray) -> np.ndarray:
    """Whether an odd number of n-grams has each hash: two to four bits for an n-gram, by powers of two.

    A bit that differs in two sets stands for at least one n-gram that only one of
    them has, also after both bitmaps are folded by exclusive or.
    """
    size = 64 * FOLDED
    while size < 2 * len(values):
        size *= 2
    bits = np.bincount((values >> np.uint64(20)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(bits.astype(bool)).view(np.int64)


def _texts(batch: pa.RecordBatch, column: str = "text"):
    data, offsets = common.utf8(batch.column(column))
    return (data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def frequency_sketch(rows: DataFrame, words: int) -> np.ndarray:
    """Documents per hash bucket of n-grams, over all documents; a fixed number of counters."""

    def count(batches):
        totals = np.zeros(SKETCH, np.int64)
        found, held = [], 0
        for batch in batches:
            for text in _texts(batch):
                found.append(_hash_bucket(shingles(text, words)))
                held += len(found[-1])
                if held > HELD:
                    totals += np.bincount(np.concatenate(found), minlength=SKETCH)
                    found, held = [], 0
        if found:
            totals += np.bincount(np.concatenate(found), minlength=SKETCH)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    counts = np.zeros(SKETCH, np.int64)
    counted = rows.select("text").mapInArrow(count, "bucket bigint, n bigint")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def _signatures(rows: DataFrame, words: int, threshold: Threshold, counts: np.ndarray) -> DataFrame:
    """Per row: size, key and bitmap of its set, and its prefix, rarest n-grams first."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)  # SKETCH numbers

    def work(batch: pa.RecordBatch):
        sizes, keys, prefixes, bitmaps = [], [], [], []
        for text in _texts(batch):
            found = shingles(text, words)
            sizes.append(len(found))
            bitmaps.append(_bitmap(found))
            if len(found):
                keys.append(xxhash.xxh3_128_hexdigest(found.tobytes()))
                order = np.lexsort((found, shared.value[_hash_bucket(found)]))
                prefixes.append(found[order[: threshold.prefix(len(found))]])
            else:
                keys.append(None)
                prefixes.append(found)
        ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes).view(np.int64)))
        steps = pa.array(np.cumsum([0, *map(len, bitmaps)]).astype(np.int32))
        signature = pa.ListArray.from_arrays(steps, pa.array(np.concatenate(bitmaps)))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ROW], pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), lists, signature],
            [*ROW, "n", "key", "prefix", "signature"],
        )

    schema = (
        "doc_id bigint, absent boolean, value bigint, digest bigint, n bigint, key string, prefix array<bigint>, "
        "signature array<bigint>"
    )
    return common.arrow_map(rows, work, schema)


def _sets_of(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(node, items) of the nodes in pairs, made again from the text of their first row."""
    met = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = cut(nodes.join(met, "node").select("node", "key", F.col("first.*")), "wanted")
    texts = common.likely(rows, F.col("value"), wanted.select("value")).join(wanted, list(ROW[1:]))
    # rows that repeat an id and a text are one; the join has dealt them out by id already
    texts = texts.dropDuplicates([*ROW[1:], "node"])

    def work(batch: pa.RecordBatch):
        found = []
        for node, key, text in zip(batch.column("node").to_pylist(), batch.column("key").to_pylist(), _texts(batch)):
            items = shingles(text, words).tobytes()
            if xxhash.xxh3_128_hexdigest(items) == key:
                found.append((node, items))
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "items"])

    return cut(common.arrow_map(texts.select("node", "key", "text"), work, "node bigint, items binary"), "sets")


def _folded() -> Column:
    """The bitmap of a node, folded to FOLDED words."""

    def word(k: int) -> Column:
        own = F.filter("signature", lambda _, i: i % FOLDED == k)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda folded, x: folded.bitwiseXOR(x))

    return F.array(*[word(k) for k in range(FOLDED)])


def _bits_allow(threshold: Threshold, a: str, b: str) -> Column:
    """Whether the folded bitmaps allow a link of two members of a bucket; no linked pair is lost."""
    differ = [F.bit_count(F.col(f"bits{a}")[i].bitwiseXOR(F.col(f"bits{b}")[i])) for i in range(FOLDED)]
    return threshold.few_apart(sum(differ[1:], differ[0]), F.col(f"n{a}"), F.col(f"n{b}"))


def _possible(pairs: DataFrame, nodes: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose whole bitmaps allow a link; a pair carries two bitmaps here, not two sets.

    The longer bitmap is folded to the length of the shorter one.
    """
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)

    def work(batch: pa.RecordBatch):
        sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
        lists = [batch.column(c) for c in ("bits_a", "bits_b")]
        (xs, at_x), (ys, at_y) = ((c.values.to_numpy().view(np.uint64), c.offsets.to_numpy()) for c in lists)
        apart = np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            x, y = xs[at_x[i] : at_x[i + 1]], ys[at_y[i] : at_y[i + 1]]
            width = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(w.reshape(-1, width)) if len(w) > width else w for w in (x, y))
            apart[i] = np.bitwise_count(x ^ y).sum()
        chosen = pa.array(threshold.few_apart(apart, *sizes))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])

    return common.arrow_map(pairs, work, "a bigint, b bigint")


def _may_link(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    """Suffix filter: at pivots of one set, the parts of both bound what they can share."""
    pivots = y[np.linspace(0, len(y) - 1, min(9, len(y))).astype(int)]
    cuts_x = np.concatenate([[0], np.searchsorted(x, pivots), [len(x)]])
    cuts_y = np.concatenate([[0], np.searchsorted(y, pivots), [len(y)]])
    return int(np.minimum(np.diff(cuts_x), np.diff(cuts_y)).sum()) >= least


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b")

    def work(batch: pa.RecordBatch):
        keep = np.zeros(batch.num_rows, bool)
        (xs, at_x), (ys, at_y) = (common.utf8(batch.column(c)) for c in ("items_a", "items_b"))
        for i in range(batch.num_rows):
            x = np.frombuffer(xs[at_x[i] : at_x[i + 1]].tobytes(), np.uint64)
            y = np.frombuffer(ys[at_y[i] : at_y[i + 1]].tobytes(), np.uint64)
            if _may_link(x, y, threshold.least_shared(len(x), len(y))):
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                keep[i] = threshold.linked(shared, len(x), len(y))
        chosen = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])

    return common.arrow_map(both, work, "a bigint, b bigint")


def link_classes(
    df: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row.

    A row's set holds the distinct n-grams of ``words`` words of its whole text (A-Z in
    lower case); rows link when 100 x intersection >= ``percent`` x union, and
    ``component_id`` is the smallest id reachable by links.

    Equal sets are one node. A node's n-grams are ordered by a frequency sketch over
    all documents, and linked nodes share one of the rarest, its prefix. Nodes meet
    by an equi-join on prefix n-grams, filtered by length and place, and each pair is
    verified once, by a suffix filter and then on whole sets. A bucket may hold a
    third of all nodes, so its members first meet a few of them; members that are
    connected by then need no comparison, and what is still apart is compared in full.
    No link between classes is lost: only pairs within a class are left out.

    Null and empty texts and texts of white space have 0 n-grams and link with
    nothing. A null id is larger than any other; a class of null ids only has a null
    ``component_id``. Repeated rows get equal results; an empty table none; other
    columns are ignored. N-grams are compared by 64-bit hashes.
    """
    found = _classified(_rows(df, id_col, text_col), words, Threshold(percent))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text, and where a row's text is found again: by its id, without id by a hash of the text."""
    rows = common.pick(df, doc_id=id_col, text=text_col)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    digest = F.xxhash64("text")
    return rows.withColumns({"absent": F.col("doc_id").isNull(), "value": F.coalesce("doc_id", digest), "digest": digest})


def _classified(rows: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """``rows`` without texts, with the size of the set, the smallest id of the class and its first row."""
    counts = frequency_sketch(rows, words)
    signed = cut(_signatures(rows, words, threshold, counts), "signed")
    nodes = signed.where("n > 0").groupBy("key", "n", "prefix", "signature")
    first_row = F.min(F.struct(*ROW[1:])).alias("first")
    nodes = nodes.agg(first_row, F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("rows"))
    # bitmaps are folded here, once for each node and not for each of its n-grams
    nodes = cut(nodes.withColumns({"node": F.monotonically_increasing_id(), "bits": _folded()}), "nodes")

    postings = nodes.select("node", "n", "bits", F.posexplode("prefix").alias("place", "gram"))
    shared = cut(postings.select("gram").groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    grams = shared.select("gram")
    buckets = cut(common.likely(postings, F.col("gram"), grams).join(grams, "gram"), "buckets")
    open_pairs = shared.agg(F.sum(F.col("size").cast("double") * (F.col("size") - 1) / 2)).first()[0] or 0
    member = cut(common.components(_all_links(nodes, rows, buckets, words, threshold, open_pairs)), "members")
    least = [F.min("first_doc").alias("component_id"), F.min("first").alias("class_first")]
    first = nodes.join(member, "node").groupBy("component").agg(*least)
    named = nodes.join(member, "node", "left").join(first, "component", "left")
    lookup = named.select("key", "rows", F.coalesce("component_id", "first_doc").alias("component_id"), F.coalesce("class_first", "first").alias("first"))
    return common.join_hot(signed.select(*ROW, "n", "key"), cut(lookup, "classes"), "key", "rows", "value")


def _all_links(nodes: DataFrame, rows: DataFrame, buckets: DataFrame, words: int, threshold: Threshold, open_pairs: float) -> DataFrame:
    """Links (a, b) that connect all nodes which any link connects.

    In each round all members of a bucket meet STARS of them, unless links connect
    them already. At the end members whose classes are still apart meet each other,
    in equal ranges of pairs; the rounds stop as soon as that makes no more pairs than
    another round, or a round leaves more than half of the ``open_pairs`` before it.
    """

    fields = ("node", "n", "bits", "place", "component")

    def member(side: str) -> list[Column]:
        return [F.col(c).alias(c + side) for c in fields]

    def centres_of(state: DataFrame, turn: int) -> DataFrame:
        """STARS members of each bucket: in the first round the one of the smallest set, else by hash."""
        kinds = [F.xxhash64("node", "gram", F.lit(turn * STARS + k)) if turn + k else F.col("n") for k in range(STARS)]
        chosen = [F.min(F.struct(kind.alias("order"), *fields)).alias(f"c{k}") for k, kind in enumerate(kinds)]
        found = state.groupBy("gram").agg(*chosen)
        each = F.array_distinct(F.array(*[F.struct(*[F.col(f"c{k}.{c}") for c in fields]) for k in range(STARS)]))
        return found.select("gram", F.explode(each).alias("c")).select("gram", *[F.col(f"c.{c}").alias(c + "_v") for c in fields])

    def apart_and_near(u: str, v: str) -> Column:
        near = threshold.can_link(f"n{u}", f"n{v}", f"place{u}", f"place{v}")
        return (F.col(f"component{u}") != F.col(f"component{v}")) & near & _bits_allow(threshold, u, v)

    def verified(met: DataFrame) -> DataFrame:
        possible = cut(_possible(met, nodes, threshold), "possible")
        return _verified(possible, _sets_of(possible, nodes, rows, words), threshold)

    links = tried = nodes.sparkSession.createDataFrame([], "a bigint, b bigint")
    state = buckets.withColumn("component", F.col("node"))
    for turn in range(ROUNDS):
        met = state.select("gram", *member("_u")).join(centres_of(state, turn), "gram").where(apart_and_near("_u", "_v"))
        met = met.select(F.least("node_u", "node_v").alias("a"), F.greatest("node_u", "node_v").alias("b")).distinct()
        met = cut(met.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = cut(verified(met), "verified")
        links, tried = links.unionByName(found), tried.unionByName(met)
        classes = cut(common.components(links), "members")
        state = cut(buckets.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node")), "state")
        parts = state.groupBy("gram", "component").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy("gram")
        apart = parts.agg(F.sum("n").alias("members"), F.sum(F.col("n") * F.col("n")).alias("within"), F.count(F.lit(1)).alias("parts"))
        apart = cut(apart.where("parts > 1").select("gram", "members", "within"), "apart")
        members, left = apart.agg(F.sum("members"), F.sum((F.col("members") * F.col("members") - F.col("within")) / 2)).first()
        state = cut(state.join(apart.select("gram"), "gram"), "state")
        left, before = left or 0, open_pairs
        if left <= STARS * (members or 0) or 2 * left > before:
            break
        open_pairs = left
    side = state.select(F.col("gram").alias("block"), F.col("node").alias("ord"), "n", "bits", "place", "component")
    met = PairRanges(side, side).meet((F.col("ord_a") < F.col("ord_b")) & apart_and_near("_a", "_b"))
    rest = met.select(F.col("ord_a").alias("a"), F.col("ord_b").alias("b")).distinct()
    return links.unionByName(verified(cut(rest.join(tried, ["a", "b"], "left_anti"), "rest")))


def keep_one(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are the first of their class, with all their columns.

    The first row is the one of the smallest id, null ids last, and of equal ids the one
    of the smallest text hash. Rows are told apart by id and text, so another text
    under the id of a dropped row stays; rows that repeat both stay or go together.
    Texts without words stay.
    """
    names = df.columns
    found = _classified(_rows(df, id_col, text_col), words, Threshold(percent))
    gone = found.where((F.col("n") > 0) & (F.struct(*ROW[1:]) != F.col("first"))).select(*ROW[1:]).distinct()
    packed = common.whole_row(df)
    key, text = F.col("row")[f"_{names.index(id_col)}"].cast("bigint"), F.col("row")[f"_{names.index(text_col)}"]
    packed = packed.withColumns({"absent": key.isNull(), "value": F.coalesce(key, F.xxhash64(text)), "digest": F.xxhash64(text)})
    return common.unpacked(packed.join(gone, list(ROW[1:]), "left_anti"), names)
