"""Ranked search against plain code and SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from scrapeloom.llm import lexical
from scrapeloom.llm.queries import ORACLES, QUERIES
from tests import compare

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, k):
    found = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    found = [(doc_id, tf) for doc_id, tf in found if tf]
    n, total = len(found), sum(sum(tf.values()) for _, tf in found)
    held = Counter(t for _, tf in found for t in tf)
    rows = []
    for item_id, text in sorted(set(items), key=repr):
        scored = []
        for doc_id, tf in found:
            m = 50 + 50 * sum(tf.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in set(terms(text))
                if tf[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda x: x[:3])
        rows += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(scored[:k], 1)]
    return sorted(rows, key=repr)


def sample(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "ß", "ÀB"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 60))) for _ in range(n)]
    docs = [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]
    docs += [(n, None), (n + 1, ""), (n + 2, " ?!\x00"), (None, texts[0]), (None, texts[1]), docs[5], (5, "w1 w2 other")]
    docs += [(n + 10 + i, "same words w3 w4") for i in range(70)] + [(n + 100, "w1 w7 " * 20_000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(12)]
    items += [(20, "w0 w1 w2 w3"), (20, "w0 w1 w2 w3"), (21, None), (22, "  "), (23, "absent"), (24, "same w3, W3!")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


@pytest.mark.parametrize("k", [3, 50])
def test_equals_plain_code(spark, k):
    docs, items = sample(1, 900)
    df, asked = frames(spark, docs, items)
    found = lexical.ranked_search(df.repartition(3), asked, k=k)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, k)


def test_small_shards_and_query_blocks(spark, monkeypatch):
    docs, items = sample(2, 400)
    df, asked = frames(spark, docs, items)
    whole = lexical.index_documents
    monkeypatch.setattr(lexical, "index_documents", lambda *a: whole(*a, shard_docs=37, shard_hits=300))
    found = lexical.ranked_search(df, asked, k=5, block_bytes=200)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, 5)


def test_blocks_are_skipped(spark):
    """Shards of which few blocks compete give the same as all blocks."""
    rng = np.random.default_rng(5)
    n = 4096
    counts = np.array([n, 200, 3])
    docs = np.concatenate([np.arange(n), np.sort(rng.choice(n, 200, False)), [7, 900, 4000]])
    tfs = np.concatenate([rng.integers(1, 4, n), rng.integers(1, 9, 200), [5, 5, 5]])

    class Column:
        def __init__(self, values):
            self.values = np.asarray(values)

        def to_numpy(self, **_):
            return self.values

        def is_valid(self):
            return Column(np.ones(len(self.values), bool))

        def fill_null(self, _):
            return self

    row = {"ids": np.arange(n), "lengths": np.full(n, 40), "terms": [0, 1, 2], "counts": counts, "docs": docs, "tfs": tfs}
    shard = lexical.Shard({c: Column(v) for c, v in row.items()}, np.array([10, 3000, 9000]), n, 40 * n)
    seen = []
    best = lexical.Best(5)
    take = best.take
    best.take = lambda *a: (seen.append(len(a[0])), take(*a))
    shard.search([0, 1, 2], best)
    m = 100
    exact = np.zeros(n, np.int64)
    for term, w in enumerate((10, 3000, 9000)):
        part = slice(counts[:term].sum(), counts[: term + 1].sum())
        exact[docs[part]] += w * (10**9 * tfs[part] // (1000 * tfs[part] + 20 * m))
    order = np.lexsort((np.arange(n), -exact))[:5]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == exact[order].tolist()
    assert sum(seen) < n // 10


def test_empty_tables_and_other_columns(spark):
    docs, items = sample(3, 50)
    df, asked = frames(spark, docs, items)
    assert lexical.ranked_search(df.limit(0), asked).collect() == []
    assert lexical.ranked_search(df, asked.limit(0)).collect() == []
    wide = df.selectExpr("*", "1 as rank", "2 as score", "'x' as `Text`", "3 as item_id", "4 as `a.b`")
    asked = asked.selectExpr("*", "1 as doc_id", "2 as query", "3 as block")
    found = lexical.ranked_search(wide, asked, k=50)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, 50)


def test_query_equals_its_sql(spark, sf_dir):
    columns, rows = compare.spark_rows(QUERIES["op11_ranked_search"](spark, sf_dir))
    assert (columns, rows) == compare.sql_rows(compare.open_tables(sf_dir), ORACLES["op11_ranked_search"])
