"""Spelling variants against plain code and SQL."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scrapeloom.llm import spelling
from scrapeloom.llm.queries import ORACLES, QUERIES
from tests import compare

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs, every=199, length=6, least=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            low = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % every == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, ratio=5):
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def sample(seed, n_docs):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdeéñÿ") for _ in range(rng.randint(6, 9))) for _ in range(25)]
    words, weights = list(bases), [200.0] * len(bases)
    for base in bases:
        word, weight = base, 200.0
        for _ in range(6):
            at = rng.randrange(len(word))
            word = rng.choice(
                [word[:at] + rng.choice("abcdxÀ") + word[at:], word[:at] + word[at + 1 :], word[:at] + rng.choice("abcdx") + word[at + 1 :]]
            )
            weight /= rng.choice([1, 2, 6])
            words.append(word)
            weights.append(weight)
    docs = []
    for i in range(n_docs):
        chosen = rng.choices(words, weights, k=rng.randint(1, 120))
        docs.append((i, rng.choice([" ", ", ", "1", "\n"]).join(w.title() if rng.random() < 0.2 else w for w in chosen)))
    long = "abcdefgh" * 400
    odd = [(None, words[0]), (None, None), (n_docs, None), (n_docs + 1, ""), docs[0], docs[0], (n_docs + 2, "ab cd éé")]
    odd += [(n_docs + 3 + i, f"{long} {long}x aaaaaaaa aaaaaaab") for i in range(6)]
    return docs + odd


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string")


@pytest.mark.parametrize("every", [199, 7])
def test_groups_equal_plain_code(spark, every):
    docs = sample(1, 150)
    found = spelling.spelling_groups(frame(spark, docs), spoil_every=every).collect()
    expected = plain_groups(plain_words(docs, every))
    assert sorted((tuple(r) for r in found), key=repr) == expected
    if every == 199:  # chains of forms, and words alone, are among them
        assert any(r[2] != r[1] for r in expected if r[1]) and any(r[4] == 0 for r in expected)


def test_words_equal_plain_code(spark):
    docs = sample(2, 80)
    found = {r.word: r.n for r in spelling.count_words(frame(spark, docs), min_length=3, min_count=1, spoil_every=2).collect()}
    assert found == plain_words(docs, 2, 3, 1)


@pytest.mark.parametrize("tuning", [{}, {"cell_words": 1, "block_letters": 64, "bucket_rows": 50}, {"cell_words": 10**6}])
def test_blocks_lose_and_repeat_nothing(spark, tuning):
    """However cells, blocks and buckets are cut; also words that share their letters."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(6, 8))): rng.randint(5, 60) for _ in range(500)}
    words |= {"".join(rng.sample("abcdefg", 7)): 5 for _ in range(300)} | {"é" * 6: 9, "é" * 7: 9, "zzzzzzzz": 5}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = sorted(tuple(r) for r in spelling.near_words(table, **tuning).collect())
    expected = []
    for w in words:
        near = [v for v in words if v != w and one_edit(v, w)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            expected.append((w, len(near), words[best], best))
    assert found == sorted(expected)


def test_gram_distance_bounds_edits():
    a = ["abcdef", "aabbcc"]
    b = ["abcdeg", "abcdfe", "aabbcx", "bcdefg"]
    i, j = spelling.near_pairs(a, b)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (1, 2)]
    i, j = spelling.near_pairs(a, ["abcde", "bcdef", "abdef", "acbde", "abbcc"])
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (0, 2), (1, 4)]
    vectors = spelling._gram_vectors(spelling._codes(["aab", "abb"], 3))
    assert np.square(vectors[0] - vectors[1]).sum() == 2


def test_empty_tables_and_other_columns(spark):
    docs = sample(4, 40)
    assert spelling.spelling_groups(frame(spark, docs).limit(0)).collect() == []
    assert spelling.spelling_groups(frame(spark, [(1, "abcdef"), (2, None)])).collect() == []
    wide = frame(spark, docs).selectExpr("*", "1 as word", "2 as n", "'x' as `Text`", "3 as cell", "4 as `a.b`")
    found = spelling.spelling_groups(wide)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_groups(plain_words(docs))
    with pytest.raises(ValueError):
        spelling.spelling_groups(wide, ratio=1)


def test_query_equals_its_sql(spark, sf_dir):
    columns, rows = compare.spark_rows(QUERIES["op12_spelling_groups"](spark, sf_dir))
    assert (columns, rows) == compare.sql_rows(compare.open_tables(sf_dir), ORACLES["op12_spelling_groups"])
