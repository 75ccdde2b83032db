"""Ranked lexical search: short lists summed term at a time, long ones walked document at a time.

An index shard holds the postings of some thousand documents. For one query, the
short lists of a shard are added up into accumulators first. From then on these are
one more iterator, with a bound of its own, beside the iterators of the long lists:
blocks of documents whose bounds together stay under the score to beat are skipped,
in the others the iterators that cannot reach it alone are only probed.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import common

BLOCK = 128  # documents that are skipped together
LONG = 8  # a list is long if it holds one in so many documents of the shard

_FOLD = bytes(
    b if b >= 0x80 or chr(b).isalnum() and b > 0x5A else b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 else 32
    for b in range(256)
)

_SHARD = (
    "ids array<bigint>, lengths array<bigint>, terms array<int>, counts array<int>, "
    "docs array<int>, tfs array<int>, n_docs bigint, n_terms bigint"
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays), kind))


def _shard_row(ids: list, lengths: list[int], found: list[np.ndarray], size: int) -> pa.RecordBatch:
    """One index row: postings by term, then by place of the document in the shard."""
    at = np.repeat(np.arange(len(ids), dtype=np.int64), [len(f) for f in found])
    key, tfs = np.unique(np.concatenate(found).astype(np.int64) * len(ids) + at, return_counts=True)
    terms, counts = np.unique(key // len(ids), return_counts=True)
    one = pa.array([0, len(ids)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(one, pa.array(ids, pa.int64())),
            _lists([np.array(lengths, np.int64)], pa.int64()),
            _lists([terms.astype(np.int32)], pa.int32()),
            _lists([counts.astype(np.int32)], pa.int32()),
            _lists([(key % len(ids)).astype(np.int32)], pa.int32()),
            _lists([tfs.astype(np.int32)], pa.int32()),
            pa.array([len(ids)], pa.int64()),
            pa.array([size], pa.int64()),
        ],
        ["ids", "lengths", "terms", "counts", "docs", "tfs", "n_docs", "n_terms"],
    )


def index_documents(
    df: DataFrame, wanted, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = 4096, shard_hits: int = 1 << 20
) -> DataFrame:
    """One row per shard with the postings of the ``wanted`` terms (a broadcast of term: number).

    A shard ends at ``shard_docs`` documents or ``shard_hits`` occurrences of wanted
    terms, whichever comes first, so a row and the memory for it are bounded by
    these and one text. Documents without any term are not in the index.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches):
        number = wanted.value.get
        ids, lengths, found, hits = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.large_binary())):
                tokens = terms_of(text.as_py() or b"")
                if not tokens:
                    continue
                numbers = np.fromiter(map(number, tokens, repeat(-1)), np.int32, len(tokens))
                ids.append(doc_id.as_py())
                lengths.append(len(tokens))
                found.append(numbers[numbers >= 0])
                hits += len(found[-1])
                if len(ids) >= shard_docs or hits >= shard_hits:
                    yield _shard_row(ids, lengths, found, sum(lengths))
                    ids, lengths, found, hits = [], [], [], 0
        if ids:
            yield _shard_row(ids, lengths, found, sum(lengths))

    return rows.mapInArrow(run, _SHARD)


class Shard:
    """The postings of some documents with their integer scores, ready to be searched."""

    def __init__(self, row: dict, weights: np.ndarray, n: int, total: int):
        self.known = row["ids"].is_valid().to_numpy(zero_copy_only=False)
        self.ids = row["ids"].fill_null(0).to_numpy()
        size = len(self.ids)
        terms, counts = row["terms"].to_numpy(), row["counts"].to_numpy()
        docs, tfs = row["docs"].to_numpy(), row["tfs"].to_numpy().astype(np.int64)
        norms = 50 + 50 * row["lengths"].to_numpy() * n // total
        scores = weights[np.repeat(terms, counts)] * (1_000_000_000 * tfs // (1000 * tfs + 20 * norms[docs]))
        ends = np.cumsum(counts)
        self.edges = np.arange(0, size, BLOCK)
        long = np.flatnonzero(counts * LONG > size)
        self.row_of = {int(terms[i]): j for j, i in enumerate(long)}
        self.long = np.zeros((len(long), size), np.int64)  # long lists by place: a probe is an index
        for j, i in enumerate(long):
            part = slice(ends[i] - counts[i], ends[i])
            self.long[j, docs[part]] = scores[part]
        self.block_max = np.maximum.reduceat(self.long, self.edges, axis=1) if len(long) else self.long[:, :0]
        self.short = {
            int(terms[i]): (docs[ends[i] - counts[i] : ends[i]], scores[ends[i] - counts[i] : ends[i]])
            for i in np.flatnonzero(counts * LONG <= size)
        }

    def accumulate(self, query: list[int]) -> np.ndarray:
        """Term at a time: the sums over the short lists, by place of the document."""
        parts = [self.short[t] for t in query if t in self.short]
        if not parts:
            return np.zeros(len(self.ids), np.int64)
        docs, scores = (np.concatenate(x) for x in zip(*parts))
        return np.bincount(docs, scores, len(self.ids)).astype(np.int64)  # sums stay far below 2^53

    def search(self, query: list[int], best: Best) -> None:
        """Document at a time over the accumulators and the long lists, block by block."""
        sums = self.accumulate(query)
        rows = np.array([self.row_of[t] for t in query if t in self.row_of], np.int64)
        own = np.maximum.reduceat(sums, self.edges)
        bounds = np.concatenate([own[None], self.block_max[rows]]) if len(rows) else own[None]
        reach = bounds.sum(axis=0)
        for b in np.flatnonzero(reach >= best.least):
            if reach[b] < best.least:  # it has risen since
                continue
            lo, hi = b * BLOCK, min((b + 1) * BLOCK, len(self.ids))
            order = np.argsort(bounds[:, b], kind="stable")
            under = np.cumsum(bounds[order, b])
            probed = int(np.searchsorted(under, best.least))  # these cannot reach it even together
            essential = order[probed:]
            scores = np.zeros(hi - lo, np.int64)
            if len(lists := essential[essential > 0]):
                scores += self.long[rows[lists - 1], lo:hi].sum(axis=0)
            if (essential == 0).any():
                scores += sums[lo:hi]
            at = np.flatnonzero(scores)
            scores = scores[at]
            for i in range(probed - 1, -1, -1):  # largest bound first
                still = scores + under[i] >= best.least
                at, scores = at[still], scores[still]
                if not len(at):
                    break
                scores = scores + (sums[lo + at] if order[i] == 0 else self.long[rows[order[i] - 1], lo + at])
            still = scores >= best.least
            if still.any():
                places = lo + at[still]
                best.take(scores[still], self.ids[places], self.known[places])


class Best:
    """The ``k`` best documents of one query so far, and the score that a further one needs."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def take(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, known])
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])  # an equal score may still win by its id


def _search_block(df: DataFrame, items: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """Hits of a bounded list of (item_id, text), not yet merged: query, item_id, doc_id, score."""
    spark = df.sparkSession
    vocabulary: dict[bytes, int] = {}
    queries = []
    for item_id, text in items:
        terms = dict.fromkeys(terms_of((text or "").encode()))
        queries.append((item_id, [vocabulary.setdefault(t, len(vocabulary)) for t in terms]))
    shards = cut(index_documents(df, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "postings")
    n, total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    lists = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms")
    held = np.zeros(len(vocabulary), np.int64)
    for term, count in lists.agg(F.sum("t.counts")).collect():  # one line per wanted term
        held[term] = count
    weights = np.floor(1000 * np.log((2 * (n or 0) + 2) / (2 * held + 1))).astype(np.int64)
    sent = spark.sparkContext.broadcast((queries, weights, int(n or 0), int(total or 0)))

    def run(batches):
        queries, weights, n, total = sent.value
        best = [Best(k) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[i].values for c in batch.schema.names[:6]}, weights, n, total)
                for (_, terms), found in zip(queries, best):
                    shard.search(terms, found)
        for number, ((item_id, _), found) in enumerate(zip(queries, best)):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(found.ids), pa.int32()),
                        pa.array([item_id] * len(found.ids), pa.int64()),
                        pa.array(found.ids, mask=~found.known),
                        pa.array(found.scores),
                    ],
                    ["query", "item_id", "doc_id", "score"],
                )

    return shards.mapInArrow(run, "query int, item_id bigint, doc_id bigint, score bigint")


def ranked_search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    block_bytes: int = 1 << 21,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of all for each query text.

    The queries go in blocks of about ``block_bytes`` of text, so what the driver
    and the broadcasts hold is bounded; each block is one pass over the documents,
    which writes the postings of its terms, and one over these. A task keeps ``k``
    documents a query; ranks are made of these in two steps, so that no task sorts
    the hits of all others.

    Null texts have no terms; documents without terms count for nothing and are
    never found, queries without terms find nothing. Equal scores go by document id,
    a null id last; rows that repeat an id are documents of their own. Queries that repeat id and text
    count once; different texts under one id are ranked each by itself. Empty tables
    give no rows, other columns are ignored.
    """
    asked = common.pick(queries, item_id=item_col, text=query_col)
    asked = asked.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for block in range(blocks):
        items = [(r[0], r[1]) for r in asked.where(block_of == block).orderBy("item_id", "text").collect()]
        hits = _search_block(df, items, k, id_col, text_col)
        found.append(hits.withColumn("block", F.lit(block)))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("block", "query", "part").orderBy(*order)
    all_ = Window.partitionBy("block", "query").orderBy(*order)
    parted = hits.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    few = parted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(all_)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
