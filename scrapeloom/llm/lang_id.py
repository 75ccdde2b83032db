"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are n-grams of one to three letters inside words, word ends included, hashed
to a fixed number of buckets. A feature's value is its share of the text's n-grams
times its inverse document frequency, so the logits of a text are sums over its
n-grams and a text of any length is read once. The weights are learned by
follow-the-regularised-leader with an elastic net, which leaves most of them zero; a
temperature fitted on texts outside the training makes the probabilities honest.
"""

from __future__ import annotations

import sys
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ORDERS = (1, 2, 3)
SCALE = 100  # a feature's share counts per hundred n-grams
PIECE = 1 << 20  # letters looked at together
UNKNOWN = "und"


class Model(NamedTuple):
    """``slots`` gives each bucket, and "none" after them, its row of ``weights`` (idf
    included); the last row is zero."""

    langs: list[str]
    slots: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    shift: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins, and a row per order with the bucket of the n-gram at each
    place, 2^bits where there is none. Every text has at least one place."""
    marked = [f"\n{t.lower()}\n" for t in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) for t in marked])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the place where a word ends
    keep[starts[:-1]] = True  # and where the first one may begin
    starts = np.concatenate([[0], np.cumsum(keep)])[starts]
    letter, codes = letter[keep], codes[keep]
    codes = np.where(letter, codes, np.uint32(0))
    n = len(codes)
    found = np.full((len(ORDERS), n), 1 << bits, np.int32)
    mixed = codes * np.uint32(0x9E3779B1)
    for row, order in zip(found, ORDERS):
        if order > 1:
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[order - 1 :]
        inside = letter if order == 1 else letter[:-1] | letter[1:] if order == 2 else letter[1:-1]
        hashed = (mixed ^ (mixed >> np.uint32(16))) * np.uint32(0xC2B2AE3D)
        row[: n - order + 1] = np.where(inside, hashed >> np.uint32(32 - bits), 1 << bits)
        for back in range(1, order):  # not across texts
            row[starts[1:] - back] = 1 << bits
    return starts[:-1], found


def _pieces(texts: list[str]):
    """Runs of neighbouring texts of about ``PIECE`` characters together: (first, texts)."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > PIECE:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, texts[lo:]


def logits(model: Model, texts: list[str]) -> np.ndarray:
    """Calibrated logits of each text, before the softmax."""
    sums = np.zeros((len(texts), len(model.langs)))
    counts = np.zeros(len(texts))
    bits = int(model.slots.size - 1).bit_length() - 1
    tables = [np.ascontiguousarray(model.weights[model.slots, c]) for c in range(len(model.langs))]
    for lo, part in _pieces(texts):
        hi = lo + len(part)
        starts, found = ngrams(part, bits)
        for row in found:
            counts[lo:hi] += np.add.reduceat(row < 1 << bits, starts, dtype=np.int64)
            for c, table in enumerate(tables):
                sums[lo:hi, c] += np.add.reduceat(table[row], starts, dtype=np.float64)
    sums *= SCALE / np.maximum(counts, 1)[:, None]
    return (sums + model.bias) / model.temperature + model.shift


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader, per coordinate, with an elastic net (McMahan et al., KDD 2013)."""

    def __init__(self, features: int, classes: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.1, l2: float = 0.5):
        self.z, self.n = np.zeros((2, features + 1, classes))  # the last feature is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, np.full(features + 1, l1), l2
        self.l1[-1] = 0

    def weights(self, at) -> np.ndarray:
        z, l1 = self.z[at], self.l1[at][:, None]
        return np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        error = _softmax((x @ w)[None])[0]
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _vector(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    buckets = ngrams([text], bits)[1].ravel()
    buckets = buckets[buckets < 1 << bits]
    at, counts = np.unique(buckets, return_counts=True)
    return at, SCALE * counts / max(1, len(buckets)) * idf[at]


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest, from a tenth to ten."""

    def loss(log_t: float) -> float:
        p = _softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, ratio = np.log(0.1), np.log(10.0), (5**0.5 - 1) / 2
    for _ in range(40):  # golden section
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(texts: list[str], labels: np.ndarray, langs: list[str], shares: np.ndarray, idf: np.ndarray, epochs: int = 3) -> Model:
    """Model of the texts; every fifth text is left out of the training and sets the temperature.

    ``shares`` are the languages' shares of the corpus; the model's priors are moved
    there from those of the sample.
    """
    bits = len(idf).bit_length() - 1
    vectors = [_vector(t, idf, bits) for t in texts]
    order = np.random.default_rng(7).permutation(len(texts))
    kept, apart = order[len(order) // 5 :], order[: len(order) // 5]
    learner = Ftrl(len(idf), len(langs))
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(kept):
            learner.learn(*vectors[i], labels[i])
    weights = learner.weights(np.arange(len(idf) + 1))
    weights, bias = weights[:-1], weights[-1]
    scores = np.array([x @ weights[at] + bias for at, x in (vectors[i] for i in apart)])
    temperature = _temperature(scores, labels[apart]) if len(apart) else 1.0
    sample = np.bincount(labels, minlength=len(langs)) + 1
    used = np.flatnonzero(weights.any(axis=1))
    slots = np.full(len(idf) + 1, len(used), np.int32)
    slots[used] = np.arange(len(used))
    rows = np.concatenate([weights[used] * idf[used, None], np.zeros((1, len(langs)))]).astype(np.float32)
    return Model(langs, slots, rows, bias, temperature, np.log(shares) - np.log(sample / sample.sum()))


def document_frequencies(rows: DataFrame, bits: int) -> np.ndarray:
    """In how many texts of the column ``text`` each bucket occurs, over all rows."""

    def run(batches):
        size = (1 << bits) + 1
        total, recent, seen, n = np.zeros(size, np.int64), np.zeros(size, np.uint8), np.zeros(size, np.uint8), 0
        for batch in batches:
            for _, part in _pieces(batch.column("text").to_pylist()):
                starts, found = ngrams(part, bits)
                for lo, hi in zip(starts, [*starts[1:], found.shape[1]]):
                    own = found[:, lo:hi]
                    seen[own] = 1
                    recent += seen
                    seen[own] = 0
                    n += 1
                    if n % 255 == 0:  # as far as a byte counts
                        total += recent
                        recent[:] = 0
        total += recent
        at = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequencies = np.zeros(1 << bits, np.int64)
    found = counted.toArrow()  # one row per bucket at most
    frequencies[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return frequencies


def train(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held: int = 2,
    per_lang: int = 1000,
    max_bytes: int = 1 << 16,
    bits: int = 18,
    max_langs: int = 1000,
) -> Model:
    """Model of the languages in ``lang_col``, from rows outside the held-out fold.

    Rows are held out when crc32(id as text) mod ``folds`` is ``held``. Document
    frequencies and the languages' shares are counted over all other rows with text
    and language. The weights are fitted on a bounded sample of these: the texts of at most
    ``per_lang`` ids of each language, in order of an id hash, less those longer than
    ``max_bytes``, as the driver holds them. Rows without id are counted but not in
    the sample; of several texts of an id the lowest is taken. Without any language
    the model knows none; more than ``max_langs`` are refused.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where((F.pmod(common.crc_of_id(), F.lit(folds)) != held) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    shares = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(max_langs + 1).collect()
    if len(shares) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs, counts = [r.lang for r in shares], np.array([r.n for r in shares], np.float64)
    frequencies = document_frequencies(rows, bits)
    idf = np.log((1 + counts.sum()) / (1 + frequencies)) + 1
    short = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") <= max_bytes))
    texts, labels = [], []
    for label, lang in enumerate(langs):
        own = short.where(F.col("lang") == lang)
        chosen = own.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_lang)  # ids only
        sample = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        for r in sample.orderBy("doc_id").collect():
            texts.append(r.text)
            labels.append(label)
    if not langs:
        return Model([], np.zeros((1 << bits) + 1, np.int32), np.zeros((1, 0), np.float32), np.zeros(0), 1.0, np.zeros(0))
    return fit(texts, np.array(labels, np.int64), langs, counts / counts.sum(), idf)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text; no letter, no language."""
    clean = [t or "" for t in texts]
    if not model.langs or not clean:
        return [UNKNOWN] * len(clean), np.zeros(len(clean))
    p = _softmax(logits(model, clean))
    best = p.argmax(axis=1)
    known = np.array([any(map(str.isalpha, t)) for t in clean])
    langs = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
    return langs, np.where(known, p[np.arange(len(clean)), best], 0.0)


def identify(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held: int = 2
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row, from its whole text.

    ``score`` is the probability of the language. A text that is null or has no
    letter, and every text if no language was learned, is ``und`` with score 0. Equal
    probabilities go to the lowest language. Null ids are held out as the empty
    text's checksum says; an empty table gives no rows; other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.pmod(common.crc_of_id(), F.lit(folds)) == held).alias("held_out"),
        "text",
    )
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by buckets and languages

    def work(batch: pa.RecordBatch):
        langs, scores = predict(sent.value, batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)],
            ["doc_id", "held_out", "lang_pred", "score"],
        )

    return common.arrow_map(rows, work, "doc_id bigint, held_out boolean, lang_pred string, score double")
