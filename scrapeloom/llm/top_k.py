"""Exact top-k by inner product with MaxScore over sharded postings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

_HITS = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


class Shard:
    """Postings of some rows: a term is a component with a sign, its postings the rows
    whose component has that sign, its bound the largest component there."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.highest, self.lowest = vectors.max(axis=0), vectors.min(axis=0)
        self.postings = np.stack([vectors < 0, vectors > 0])

    def top(self, query: np.ndarray, query_id: int, k: int, step: int = 8) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) for one query, ties to the smaller id (MaxScore).

        The query takes each component with its own sign; rows outside that posting
        add nothing or less, so a term's bound holds for every row. The terms of
        smallest bounds whose sum stays under the threshold are non-essential: a row
        in none of the essential postings cannot compete. Rows found there are probed
        in the other terms while their partial score and the bounds of what is left
        reach the threshold, the k-th best score among rows scored beforehand.
        """
        vectors, alive = self.vectors, np.flatnonzero(self.ids != query_id)
        bounds = np.maximum(np.where(query >= 0, self.highest, self.lowest) * query, 0)
        order = np.argsort(-bounds, kind="stable")
        rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])  # bound of terms i..
        threshold = None
        if len(alive) > k:
            likely = vectors[np.ix_(alive, order[:4])] @ query[order[:4]]
            first = alive[np.argpartition(-likely, min(len(alive) - 1, 8 * k))[: 8 * k]]
            scored = np.sort(vectors[first] @ query)[::-1]
            threshold = scored[k - 1] if len(scored) >= k else None
        if threshold is not None and threshold > 0:
            essential = order[: np.count_nonzero(rest >= threshold)]
            signs = (query[essential] > 0).astype(int)
            posted = np.zeros(len(self.ids), bool)
            for sign, term in zip(signs, essential):
                posted |= self.postings[sign, :, term]
            alive = alive[posted[alive]]
        partial = np.zeros(len(alive), np.int64)
        for start in range(0, len(order), step):
            terms = order[start : start + step]
            partial += vectors[np.ix_(alive, terms)] @ query[terms]
            if threshold is not None:
                still = partial + rest[min(start + step, len(order))] >= threshold
                alive, partial = alive[still], partial[still]
        best = np.lexsort((self.ids[alive], -partial))[:k]
        return [(int(partial[i]), int(self.ids[alive[i]])) for i in best]


def _stack(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["vector"].to_numpy()).astype(np.int64)


def exact_top_k(
    df: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query row.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows
    of the same length with another id. Components become floor(scale * x). Rows are dealt by
    id hash to shards of about ``shard_rows``, queries to blocks of about
    ``query_rows``; every shard meets every block once and returns at most ``k`` hits
    a query, which are merged. The work is one pass of the stated query set over
    all rows; memory is bounded by a shard and a block.

    Rows whose vector is null, empty or holds a null or non-finite component, and
    rows without id, take no part. Repeated rows are candidates each and one query;
    different vectors under one id are a query each. Fewer rows than ``k`` give all of
    them; an empty table gives no rows.
    """
    rows = common.pick(df, vec_id=id_col, vector=vector_col)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")).alias("vector"),
        F.size("vector").alias("width"),
    )
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // query_rows))

    def every_one(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # salted by row, so that rows that share an id spread as well
    own_shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    own_block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    candidates = rows.select("*", own_shard.alias("shard"), every_one(blocks).alias("block"))
    asked = rows.where(is_query).distinct().withColumn("query_key", F.xxhash64("vector"))
    queries = asked.select("*", every_one(shards).alias("shard"), own_block.alias("block"))
    keys = ("width", "shard", "block")

    def meet(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(queries) and len(candidates):
            shard = Shard(_stack(candidates), candidates["vec_id"].to_numpy())
            for query_id, key, query in zip(queries["vec_id"], queries["query_key"], _stack(queries)):
                hits += [(query_id, key, vec_id, score) for score, vec_id in shard.top(query, query_id, k)]
        return pd.DataFrame(hits, columns=["query_id", "query_key", "vec_id", "score"])

    hits = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(meet, _HITS)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
