"""Language identification: held-out accuracy, and scores against plain code."""

import math
import random
import zlib

import numpy as np
import pytest

from scrapeloom.llm import lang_id
from scrapeloom.llm.queries import QUERIES

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["ção", "né", "ou", "èr"]}


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        pool = SYLLABLES[lang] + ["na", "re", "st"]
        words = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 80))]
        rows.append((i, rng.choice([" ", ". ", " 7 "]).join(words).capitalize(), lang))
    odd = [(n, None, "aa"), (n + 1, "", "bb"), (n + 2, " 12 !?\n", "cc"), (n + 3, rows[0][1], None), (None, rows[1][1], "aa")]
    odd += [rows[2], rows[2], (n + 4, "ß", "bb"), (n + 5, "kalo " * 30_000, "aa"), (n + 6, "日本語", "aa")]
    return rows + odd


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def rows():
    return sample(1, 400)


@pytest.fixture(scope="module")
def model(spark, rows):
    return lang_id.train(frame(spark, rows), bits=14)


def grams(text):
    """All n-grams of one to three letters inside words, with word ends, as plain strings."""
    found, word = [], ""
    for c in [*text.lower(), "\n"]:
        if c.isalpha():
            word += c
        elif word:
            marked = f"\0{word}\0"
            found += list(word) + [marked[i : i + 2] for i in range(len(marked) - 1)]
            found += [marked[i : i + 3] for i in range(len(marked) - 2)]
            word = ""
    return found


def own_buckets(text, bits):
    found = lang_id.ngrams([text], bits)[1].ravel()
    return found[found < 1 << bits].tolist()


def test_ngrams_are_those_of_plain_code():
    texts = ["Ab c, 12éß", "", "  ", "x", "a\0b A.b", "日本 語", "The end"]
    starts, found = lang_id.ngrams(texts, 30)
    for text, lo, hi in zip(texts, starts, [*starts[1:], found.shape[1]]):
        own = [b for b in found[:, lo:hi].ravel().tolist() if b < 1 << 30]
        assert sorted(own) == sorted(own_buckets(text, 30))  # whatever its neighbours are
        # equal n-grams share a bucket, others do not: compare how often each occurs
        assert sorted(own.count(b) for b in own) == sorted(grams(text).count(g) for g in grams(text))


def test_document_frequencies_count_every_text(spark, rows):
    table = frame(spark, rows).where("text is not null")
    found = lang_id.document_frequencies(table.repartition(3), 14)
    expected = np.zeros(1 << 14, np.int64)
    for r in table.collect():
        for bucket in set(own_buckets(r.text, 14)):
            expected[bucket] += 1
    assert (found == expected).all()


def test_held_out_accuracy_and_fold(spark, rows, model):
    found = lang_id.identify(frame(spark, rows), model).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r for r in rows}
    held = [r for r in found if r.held_out and r.doc_id is not None and r.lang_pred != "und" and truth[r.doc_id][2]]
    assert len(held) > 60
    assert sum(truth[r.doc_id][2] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    n = 400
    by_id = {r.doc_id: r for r in found}
    assert [by_id[n + i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and by_id[n + 1].score == 0
    assert by_id[n + 5].lang_pred == "aa" and by_id[n + 6].lang_pred != "und"


def test_scores_equal_plain_sums(rows, model):
    """The probability of a text from its n-grams one by one."""
    texts = [r[1] for r in rows if r[1]][:60]
    langs, scores = lang_id.predict(model, texts)
    for text, lang, score in zip(texts, langs, scores):
        buckets = own_buckets(text, 14)
        if not buckets:
            continue
        sums = [0.0] * len(model.langs)
        for b in buckets:
            for c in range(len(sums)):
                sums[c] += float(model.weights[model.slots[b], c])
        z = [(lang_id.SCALE * s / len(buckets) + model.bias[c]) / model.temperature + model.shift[c] for c, s in enumerate(sums)]
        top = max(z)
        p = [math.exp(x - top) for x in z]
        assert lang == model.langs[p.index(max(p))]
        assert score == pytest.approx(max(p) / sum(p), abs=1e-9)


def test_learner_follows_its_formula():
    """One coordinate, step by step, and weights that the first penalty keeps at zero."""
    ftrl = lang_id.Ftrl(2, 2, alpha=0.5, beta=1.0, l1=0.2, l2=0.3)
    z, n, w = 0.0, 0.0, 0.0
    for x, label in ((1.0, 0), (2.0, 1), (0.5, 0)):
        at = np.array([0])
        scores = np.array([x, 1.0]) @ ftrl.weights(np.array([0, 2]))
        p = np.exp(scores) / np.exp(scores).sum()
        g = x * (p[0] - (label == 0))
        ftrl.learn(at, np.array([x]), label)
        z += g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w
        n += g * g
        w = 0.0 if abs(z) <= 0.2 else -(z - math.copysign(0.2, z)) / ((1 + math.sqrt(n)) / 0.5 + 0.3)
        assert ftrl.weights(at)[0, 0] == pytest.approx(w)
    assert (ftrl.weights(np.array([1])) == 0).all()


def test_weights_are_sparse_and_calibration_helps(rows, model):
    assert 0 < len(model.weights) - 1 < 0.5 * len(model.slots)
    assert 0.1 <= model.temperature <= 10
    rng = np.random.default_rng(1)
    scores, labels = rng.normal(size=(500, 3)), rng.integers(0, 3, 500)
    scores[np.arange(500), labels] += 1.5
    t = lang_id._temperature(scores * 4, labels)
    assert t == pytest.approx(4 * lang_id._temperature(scores, labels), rel=0.02)


def test_parts_of_the_data_that_must_not_matter(spark, rows, model):
    """Held-out rows, their languages and the order of the rows change nothing."""
    table = frame(spark, rows)
    spoiled = table.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'other' else lang end as lang")
    other = lang_id.train(spoiled.repartition(5), bits=14)
    assert other.langs == model.langs and (other.weights == model.weights).all() and other.temperature == model.temperature


def test_empty_tables_one_language_and_other_columns(spark, rows, model):
    table = frame(spark, rows)
    assert lang_id.identify(table.limit(0), model).collect() == []
    nothing = lang_id.train(table.limit(0))
    assert {(r.lang_pred, r.score) for r in lang_id.identify(table, nothing).collect()} == {("und", 0.0)}
    unlabelled = lang_id.train(table.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert unlabelled.langs == []
    single = lang_id.train(table.where("lang = 'aa'"), bits=14)
    found = lang_id.identify(table.where("lang = 'aa'"), single).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("aa", 1.0), ("und", 0.0)}
    wide = table.selectExpr("*", "1 as score", "'x' as `Text`", "2 as held_out", "3 as `a.b`", "4 as n")
    assert sorted(map(repr, lang_id.identify(wide, model).collect())) == sorted(map(repr, lang_id.identify(table, model).collect()))
    with pytest.raises(ValueError):
        lang_id.train(table, max_langs=2)


def test_query_on_the_given_tables(spark, sf_dir):
    found = QUERIES["op13_language_id"](spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)
