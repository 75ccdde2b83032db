"""Which rows the filtering operators keep, row by row, and what reaches the driver."""

import ast
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrapeloom.llm import exact_dedup, mixing, near_join, pieces
from scrapeloom.llm.queries import MIX, PIECES

ROWS = [
    (1, "t", "en", "a"), (2, "t", "en", "a"), (2, "unique", "en", "a"), (3, "t \n", "en", "b"),
    (None, "lone", "en", "a"), (None, "lone", "de", "b"), (None, "t", "en", "a"), (None, "other", None, None),
    (5, None, "en", "a"), (4, "", "en", "a"), (6, "again", "en", "a"), (6, "again", "en", "a"), (6, " again", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_one_row_of_each_group_of_equal_texts_stays(spark):
    kept = [tuple(r) for r in exact_dedup.drop_duplicates(spark.createDataFrame(ROWS, SCHEMA)).collect()]
    assert set(kept) <= set(ROWS)
    assert Counter(normal(r[1]) for r in kept) == Counter({normal(r[1]) for r in ROWS})
    for text in {normal(r[1]) for r in ROWS}:
        ids = [r[0] for r in ROWS if normal(r[1]) == text and r[0] is not None]
        assert [r[0] for r in kept if normal(r[1]) == text] == [min(ids, default=None)]


def test_rows_are_sampled_by_their_own_cell(spark):
    """As the row-wise operator decides, also where ids are null or shared by other texts."""
    df = spark.createDataFrame([(i % 7 or None, f"{'word ' * (i % 9)}{i}", "en" if i % 3 else "de", f"s{i % 2}") for i in range(300)], SCHEMA)
    decided = mixing.sample_to_targets(df.withColumn("doc_id", F.col("doc_id")), MIX, seed=3)
    kept = mixing.keep_sampled(df, MIX, seed=3)
    assert kept.columns == df.columns
    counts = Counter((r.doc_id, r.lang, r.source, r.topic, r.tokens) for r in decided.where("sampled").collect())
    labelled = kept.select("doc_id", "lang", "source", mixing.text_form().alias("topic"), mixing.word_count().alias("tokens"))
    assert Counter(map(tuple, labelled.collect())) == counts
    assert 0 < kept.count() < 300
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len(set(texts))


@pytest.mark.parametrize("char", ["x", "=", " "])
def test_ties_do_not_unfold(char):
    """Runs of one character of any length, where very many segmentations share a score."""
    vocabulary = pieces.Vocabulary.load(PIECES)
    for n in [*range(1, 70), *range(70, 3001, 97), 800, 1600, 3000]:
        found = vocabulary.best(char * n, 2)
        assert found[0][0] >= found[-1][0] and len(found) <= 2


def test_what_reaches_the_driver_is_bounded():
    """Every collect of the corpus operators, by module, with the bound of what it brings."""
    bounded = {
        "bilinear_lm": "parameters of the model and counts of frequent words",
        "lang_id": "a row per language, and the sample of labelled texts (per_lang, max_bytes)",
        "lexical": "a block of queries (block_bytes), and a row per term of it",
        "near_join": "the frequency sketch",
        "pieces": "a row per piece of the vocabulary",
        "quality_net": "the sample of labelled texts (per_class, max_bytes)",
        "sharding": "splitters, a few per shard",
    }
    found = set()
    for path in (Path(__file__).resolve().parents[2] / "scrapeloom" / "llm").glob("*.py"):
        names = {getattr(n, "attr", None) for n in ast.walk(ast.parse(path.read_text()))}
        if names & {"collect", "toPandas", "toArrow"}:
            found.add(path.stem)
        assert not names & {"localCheckpoint", "rdd", "crossJoin", "cache", "persist"}, path
    assert found == set(bounded)


def test_near_join_keeps_other_texts_of_a_dropped_id(spark):
    """Rows are dropped by id and text, also where the id is null or repeated."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base + " end"), (2, "something quite different that nobody else holds"), (None, base + " stop"),
            (None, ""), (None, None), (3, None), (4, "lone words here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {(r.doc_id, r.text) for r in near_join.keep_one(df).collect()}
    assert kept == set(rows) - {rows[1], rows[3]}


def test_bitmaps_lose_no_linked_pair(spark):
    """All pairs of related texts of very different sizes: what links passes the bitmap filter."""
    rng = random.Random(5)
    texts = []
    for size in (6, 40, 300, 4000):
        base = [f"w{rng.randrange(900)}" for _ in range(size)]
        texts += [" ".join(base[: size - size * cut // 100] + [f"x{cut}"] * (cut % 3)) for cut in range(0, 30, 2)]
    limit = near_join.Threshold(85)
    found = [near_join.shingles(t.encode(), 4) for t in texts]
    nodes = spark.createDataFrame(
        [(i, len(f), near_join._bitmap(f).tolist()) for i, f in enumerate(found)], "node bigint, n bigint, signature array<bigint>"
    )
    every = [(i, j) for i in range(len(found)) for j in range(i)]
    passed = {tuple(r) for r in near_join._possible(spark.createDataFrame(every, "a bigint, b bigint"), nodes, limit).collect()}
    linked = set()
    for i, j in every:
        both = len(np.intersect1d(found[i], found[j]))
        if limit.linked(both, len(found[i]), len(found[j])):
            linked.add((i, j))
    assert linked and linked <= passed and len(passed) < len(every) / 2


def test_bitmaps_tell_near_misses_apart(spark):
    """Short and long sets: pairs just above the limit pass, also between bitmaps of two lengths; most below it do not."""
    rng = np.random.default_rng(7)
    limit = near_join.Threshold(85)
    rows, links, misses = [], [], []
    for n in (120, 127, 1000, 4090):
        base = np.unique(rng.integers(0, 1 << 62, 2 * n).astype(np.uint64) * np.uint64(2))
        for other in range(20):
            apart = n // 14 if other < 10 else n // 8  # of both sets; similarity 0.87 and 0.78
            grown = (n + apart + other % 10, n - apart // 2)[other % 2]
            found = [base[:n], base[apart : apart + grown]]
            both = len(np.intersect1d(*found))
            (links if limit.linked(both, n, len(found[1])) else misses).append((len(rows), len(rows) + 1))
            rows += [(len(rows) + i, len(f), near_join._bitmap(f).tolist()) for i, f in enumerate(found)]
    nodes = spark.createDataFrame(rows, "node bigint, n bigint, signature array<bigint>")
    pairs = spark.createDataFrame(links + misses, "a bigint, b bigint")
    passed = {tuple(r) for r in near_join._possible(pairs, nodes, limit).collect()}
    assert len(links) >= 20 and set(links) <= passed
    assert len(misses) >= 20 and len(passed & set(misses)) < len(misses) / 4
    assert len({len(r[2]) for r in rows}) > 3
    short = nodes.select("node", "n", near_join._folded().alias("bits"))
    for side in ("a", "b"):
        pairs = pairs.join(short.select(*[F.col(c).alias(c if c == "node" else f"{c}_{side}") for c in short.columns]).withColumnRenamed("node", side), side)
    assert set(links) <= {tuple(r) for r in pairs.where(near_join._bits_allow(limit, "_a", "_b")).select("a", "b").collect()}
