"""Quality of texts by a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH, STRIDE = 8, 2  # bytes a filter sees, bytes between its places
BLOCK = 64  # bytes pooled first
CHUNK, HOP = 8, 7  # blocks in a chunk, blocks between chunk starts: neighbours overlap by one
PAD = 256  # symbol after the end of a text
PIECE = 2048  # blocks convolved at once


@dataclass
class Net:
    """Filters over bytes; chunks max-pooled; a layer per chunk; pooled over chunks."""

    filters: np.ndarray  # WIDTH x 257 x n
    layer: np.ndarray  # n x m
    shift: np.ndarray  # m
    out: np.ndarray  # 3m: mean, maximum and minimum over chunks
    bias: np.ndarray  # 1
    moments: dict = field(default_factory=dict, repr=False)

    @classmethod
    def fresh(cls, n: int = 16, m: int = 16, seed: int = 7) -> Net:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            draw(WIDTH, 257, n, scale=0.3),
            draw(n, m, scale=0.3),
            np.zeros(m, np.float32),
            draw(3 * m, scale=0.1),
            np.zeros(1, np.float32),
        )

    @property
    def weights(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("filters", "layer", "shift", "out", "bias")}


def to_blocks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of several texts, each padded to whole blocks, and where the blocks of each begin.

    The last block of each text is all padding, so that no filter sees the next text.
    """
    sizes = np.diff(offsets)
    blocks = (sizes + WIDTH) // BLOCK + 2
    starts = np.concatenate([[0], np.cumsum(blocks)])
    symbols = np.full(starts[-1] * BLOCK, PAD, np.uint16)
    shift = np.repeat(starts[:-1] * BLOCK - offsets[:-1], sizes)
    symbols[np.arange(len(data)) + shift] = data
    return symbols, starts


def convolve(net: Net, symbols: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Maximum of each filter in each block, and the place of it if asked for."""
    n, count = net.filters.shape[2], len(symbols) // BLOCK
    pooled = np.empty((count, n), np.float32)
    where = np.empty((count, n), np.int64) if places else None
    symbols = np.concatenate([symbols, np.full(WIDTH, PAD, symbols.dtype)])
    for start in range(0, count, PIECE):
        end = min(count, start + PIECE)
        lo, size = start * BLOCK, (end - start) * BLOCK
        found = net.filters[0][symbols[lo : lo + size : STRIDE]]
        for k in range(1, WIDTH):
            found += net.filters[k][symbols[lo + k : lo + k + size : STRIDE]]
        found = found.reshape(end - start, BLOCK // STRIDE, n)
        if places:
            best = found.argmax(axis=1)
            where[start:end] = best * STRIDE + (np.arange(start, end) * BLOCK)[:, None]
        pooled[start:end] = found.max(axis=1)
    return pooled, where


def chunk_bounds(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last block (exclusive) of each chunk, and the first chunk of each text."""
    blocks = np.diff(starts) - 1  # without the last, which only parts the texts
    chunks = np.maximum(1, -(-(blocks - (CHUNK - HOP)) // HOP))
    first = np.concatenate([[0], np.cumsum(chunks)])
    inside = np.arange(first[-1]) - np.repeat(first[:-1], chunks)
    lo = np.repeat(starts[:-1], chunks) + inside * HOP
    return lo, np.minimum(lo + CHUNK, np.repeat(starts[1:] - 1, chunks)), first


def _chunk_max(pooled: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Maximum over each chunk's blocks."""
    found = pooled[lo].copy()
    for k in range(1, CHUNK):
        np.maximum(found, pooled[np.minimum(lo + k, hi - 1)], out=found)
    return found


def _forward(net: Net, chunks: np.ndarray, first: np.ndarray):
    hidden = np.tanh(np.maximum(chunks, 0) @ net.layer + net.shift)
    counts = np.diff(first)[:, None]
    mean = np.add.reduceat(hidden, first[:-1], axis=0) / counts
    highest = np.maximum.reduceat(hidden, first[:-1], axis=0)
    lowest = np.minimum.reduceat(hidden, first[:-1], axis=0)
    features = np.concatenate([mean, highest, lowest], axis=1)
    return hidden, features, features @ net.out + net.bias[0]


def probability(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of each text, all bytes of it seen."""
    if len(offsets) < 2:
        return np.zeros(0)
    symbols, starts = to_blocks(data, offsets)
    pooled, _ = convolve(net, symbols)
    lo, hi, first = chunk_bounds(starts)
    logits = _forward(net, _chunk_max(pooled, lo, hi), first)[2].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _gradients(net: Net, data: np.ndarray, offsets: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    symbols, starts = to_blocks(data, offsets)
    pooled, where = convolve(net, symbols, places=True)
    lo, hi, first = chunk_bounds(starts)
    n, m = net.layer.shape
    best = np.repeat(lo[:, None], n, axis=1)
    chunks = pooled[lo].copy()
    for k in range(1, CHUNK):
        block = np.minimum(lo + k, hi - 1)
        better = pooled[block] > chunks
        chunks = np.where(better, pooled[block], chunks)
        best = np.where(better, block[:, None], best)
    hidden, features, logits = _forward(net, chunks, first)
    slope = ((1 / (1 + np.exp(-np.clip(logits, -30, 30)))) - target) / len(target)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    back = (slope[text] / counts[text])[:, None] * net.out[:m]
    for part, at in ((1, features[:, m : 2 * m]), (2, features[:, 2 * m :])):
        back = back + np.where(hidden == at[text], slope[text][:, None] * net.out[part * m : (part + 1) * m], 0)
    back = back * (1 - hidden**2)
    active = np.maximum(chunks, 0)
    down = np.where(chunks > 0, back @ net.layer.T, 0).astype(np.float32)
    place = where[best, np.arange(n)]
    filters = np.zeros_like(net.filters)
    padded = np.concatenate([symbols, np.full(WIDTH, PAD, symbols.dtype)])
    column = np.broadcast_to(np.arange(n), place.shape)
    for k in range(WIDTH):
        flat = padded[place + k].astype(np.int64) * n + column
        filters[k] = np.bincount(flat.ravel(), down.ravel(), 257 * n).reshape(257, n)
    return {
        "filters": filters,
        "layer": active.T @ back,
        "shift": back.sum(axis=0),
        "out": features.T @ slope,
        "bias": slope.sum(keepdims=True),
    }


def _adam(net: Net, gradients: dict[str, np.ndarray], rate: float, step: int) -> None:
    for name, weight in net.weights.items():
        g = gradients[name].astype(np.float32)
        first, second = net.moments.setdefault(name, (np.zeros_like(weight), np.zeros_like(weight)))
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        weight -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)


def fit(texts: list[bytes], labels: np.ndarray, prior: float, epochs: int = 14, batch: int = 64, rate: float = 0.01) -> Net:
    """Network trained on the texts, each class counting alike, then shifted to ``prior``."""
    net = Net.fresh()
    labels = np.asarray(labels, np.float32)
    if len(texts) and 0 < labels.mean() < 1:
        rng, step = np.random.default_rng(11), 0
        steps = epochs * -(-len(texts) // batch)
        ones, zeros = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        for _ in range(epochs):
            picked = np.concatenate([rng.permutation(np.resize(rng.permutation(c), len(texts) // 2 + 1)) for c in (ones, zeros)])
            for part in np.array_split(rng.permutation(picked), -(-len(picked) // batch)):
                step += 1
                data = np.frombuffer(b"".join(texts[i] for i in part), np.uint8)
                offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in part])])
                _adam(net, _gradients(net, data, offsets, labels[part]), rate * max(0.05, 1 - step / steps), step)
    else:
        net.out[:] = 0
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    net.bias += np.float32(np.log(prior / (1 - prior)))
    net.moments.clear()
    return net


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    per_class: int = 1000,
    max_bytes: int = 1 << 16,
) -> Net:
    """Network fitted on a bounded sample of labelled rows outside the held-out fold.

    The sample holds the texts of at most ``per_class`` ids of each label, taken in
    order of an id hash, less those longer than ``max_bytes``: the only bounded step,
    as the driver holds these texts. The share of label 1 is counted over all labelled rows of the
    other folds. Rows are held out when crc32(id as text) mod ``folds`` is 0. Null
    or other labels are not learned from; of several labels of an id the smallest
    counts. Without two classes every text gets the share of label 1.
    """
    marks = common.pick(labels, doc_id=id_col, label=label_col).where(F.col("label").isin(0, 1))
    marks = marks.where(F.col("doc_id").isNotNull() & (F.pmod(common.crc_of_id(), F.lit(folds)) != 0))
    marks = marks.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    rows = common.pick(df, doc_id=id_col, text=text_col).select("doc_id", common.text_of().alias("text"))
    texts: list[bytes] = []
    found: list[int] = []
    for label in (0, 1):
        order = F.xxhash64("doc_id")
        chosen = marks.where(F.col("label") == label).orderBy(order, "doc_id").limit(per_class)  # ids only
        short = rows.where(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "doc_id")
        for r in short.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect():
            texts.append(r.text.encode())
            found.append(label)
    share = marks.agg(F.avg("label")).first()[0]
    return fit(texts, np.array(found), 0.5 if share is None else share)


def score_quality(
    df: DataFrame,
    net: Net,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    cut_off: float = 0.3,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row, from its whole text.

    A text of any length is cut into overlapping chunks that cover all its bytes;
    chunk maxima are combined into one probability of label 1. Empty and null texts
    are scored as a chunk of padding. Null ids are held out like the empty text's
    checksum says. An empty table gives no rows; other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col)
    rows = rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.pmod(common.crc_of_id(), F.lit(folds)) == 0).alias("held_out"),
        "text",
    )

    def work(batch: pa.RecordBatch):
        data, offsets = common.utf8(batch.column("text"))
        scores = np.empty(batch.num_rows)
        lo = 0
        while lo < batch.num_rows:  # whole texts, about a megabyte at a time
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20))))
            hi = min(hi, batch.num_rows)
            part = offsets[lo : hi + 1]
            scores[lo:hi] = probability(net, data[part[0] : part[-1]], part - part[0])
            lo = hi
        predicted = (scores >= cut_off).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array(predicted)],
            ["doc_id", "held_out", "score", "predicted"],
        )

    return common.arrow_map(rows, work, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(df: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text", cut_off: float = 0.3) -> DataFrame:
    """The rows of ``df`` that the network does not reject, with all their columns."""
    if not df.columns:
        return df
    names = df.columns
    at = names.index(text_col)
    flat = df.toDF(*[f"_{i}" for i in range(len(names))])  # names may clash

    def work(batch: pa.RecordBatch):
        data, offsets = common.utf8(batch.column(at))
        keep = np.empty(batch.num_rows, bool)
        lo = 0
        while lo < batch.num_rows:
            hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20)))), batch.num_rows)
            part = offsets[lo : hi + 1]
            keep[lo:hi] = probability(net, data[part[0] : part[-1]], part - part[0]) >= cut_off
            lo = hi
        yield batch.filter(pa.array(keep))

    return common.arrow_map(flat, work, flat.schema).toDF(*names)
