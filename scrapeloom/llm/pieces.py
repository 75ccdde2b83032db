"""Encoding to word pieces with the n best segmentations, and decoding."""

from __future__ import annotations

import copy
import heapq
import math
from collections import Counter
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common

SPACE = "▁"  # how the vocabulary writes a space
MISSING = -1e5  # score of a character that no piece covers; it is spelled in bytes
CACHED_UNITS = 400_000  # segmentations kept per Python worker
LONG_UNIT = 256  # characters; longer units are not kept
GRID = 2.0**16  # scores are multiples of 1/GRID, so that sums of them are exact
SHARES = 1024  # expected uses are counted in parts of this
PRIOR = 0.1  # uses that each piece has before any is counted
FLUSH = 300_000  # distinct units counted before they are handed on
ROUNDS = 3  # of expectation and maximisation

Path = tuple[float, tuple[int, ...]]
Change = tuple[int, int, tuple[int, ...]]  # where pieces of the best path are replaced, how many, and by which
Other = tuple[float, list[Change]]


def _classes(joints: set[str]) -> list[str]:
    """Characters that pieces link with each other, directly or by way of others."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for left, right in sorted(joints):
        if SPACE not in (left, right):
            root[find(left)] = find(right)
    groups: dict[str, list[str]] = {}
    for c in sorted(root):
        groups.setdefault(find(c), []).append(c)
    return ["".join(g) for g in sorted(groups.values(), key=lambda g: (-len(g), g))]


def _log_shares(uses: np.ndarray, ids: list[int]) -> np.ndarray:
    """Log-probability of each piece, on the grid; 0 for what is no piece."""
    scores = np.zeros(len(uses))
    scores[ids] = np.rint(np.log(uses[ids] / uses[ids].sum()) * GRID) / GRID
    return scores


class Solved:
    """Best paths of units: a number per unit, and arrays by that number."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)
        self.scores = self.losses = np.zeros(0)
        self.next: dict[tuple[int, int], list[Path]] = {}  # by unit and n: what its other paths lose, and their ids

    def add(self, units: list[str], ids: np.ndarray, counts: np.ndarray, scores: np.ndarray, losses: np.ndarray) -> None:
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.scores = np.concatenate([self.scores, scores])
        self.losses = np.concatenate([self.losses, losses])

    def path(self, number: int) -> tuple[int, ...]:
        return tuple(self.ids[self.starts[number] : self.starts[number] + self.counts[number]].tolist())

    def paths(self, numbers: np.ndarray) -> np.ndarray:
        counts = self.counts[numbers]
        return self.ids[np.arange(counts.sum()) + np.repeat(self.starts[numbers] - (np.cumsum(counts) - counts), counts)]


class Vocabulary:
    """Pieces with scores, and where a text may be cut without cutting a piece."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int):
        self.pieces, self.byte_ids, self.size = pieces, byte_ids, size
        self.longest = max(map(len, pieces), default=1)
        joints = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        # No piece holds a space after another character or characters of two classes,
        # so a text is a chain of units: spaces with a run of characters of one class.
        self.chained = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.char_class = np.zeros(0x110000, np.int32)  # 0: a unit of its own
        for i, chars in enumerate(_classes(joints)):
            self.char_class[[ord(c) for c in chars]] = i + 1
        texts = {i: p.replace(SPACE, " ").encode() for p, (i, _) in pieces.items()}
        texts |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.widths = np.array([len(texts.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.widths) - self.widths
        self.pool = np.frombuffer(b"".join(texts.get(i, b"") for i in range(size)), np.uint8)
        self._build_trie()
        self._kept = Solved()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model with bytes for characters outside of it.

        The scores of a merge model are ranks, no log-probabilities: their sum prefers
        many early merges to one long piece. Only their order is taken, as if the use of
        pieces fell off by rank; :meth:`rescored` has the probabilities of a corpus.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        byte_ids, pieces = [0] * 256, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = (i, model.get_score(i))
        uses = np.zeros(size)
        for rank, (i, _) in enumerate(sorted(pieces.values(), key=lambda x: (-x[1], x[0]))):
            uses[i] = 1 / (rank + 1)
        scores = _log_shares(uses, [i for i, _ in pieces.values()])
        return cls({p: (i, float(scores[i])) for p, (i, _) in pieces.items()}, byte_ids, size)

    def rescored(self, ids: np.ndarray, uses: np.ndarray) -> Vocabulary:
        """The same pieces with log-probabilities by how often a corpus uses them."""
        counted = np.full(self.size, PRIOR)
        counted[ids] += uses
        scores = _log_shares(counted, [i for i, _ in self.pieces.values()])
        other = copy.copy(self)
        other.pieces = {p: (i, float(scores[i])) for p, (i, _) in self.pieces.items()}
        other._scores = np.where(self._ids >= 0, scores[self._ids], 0.0)
        other._kept = Solved()
        return other

    def _build_trie(self) -> None:
        alphabet = sorted({c for p in self.pieces for c in p})
        self.symbol = np.zeros(0x110000, np.int32)  # 0: in no piece
        for i, c in enumerate(alphabet):
            self.symbol[ord(c)] = i + 1
        width = len(alphabet) + 1
        children: dict[int, int] = {}
        ids, scores = [-1], [0.0]
        for piece, (i, score) in self.pieces.items():
            node = 0
            for c in piece:
                key = node * width + int(self.symbol[ord(c)])
                if key not in children:
                    children[key] = len(ids)
                    ids.append(-1)
                    scores.append(0.0)
                node = children[key]
            ids[node], scores[node] = i, score
        self._width = width
        self._keys = np.array(sorted(children), np.int64)
        self._child = np.array([children[k] for k in self._keys.tolist()], np.int64)
        first = self._keys[self._keys < width]
        self._first = np.full(width, -1, np.int64)  # children of the root by symbol
        self._first[first] = self._child[: len(first)]
        self._ids, self._scores = np.array(ids, np.int64), np.array(scores)

    def _spelled(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    # The n best paths through one unit.

    def arcs(self, text: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each place, the pieces that end there: (start, ids, score)."""
        ending: list[list] = [[] for _ in range(len(text) + 1)]
        for start, char in enumerate(text):
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = self.pieces.get(text[start:end])
                if piece is not None:
                    ending[end].append((start, (piece[0],), piece[1]))
                elif end == start + 1:
                    ending[end].append((start, self._spelled(char), MISSING))
        return ending

    def best(self, text: str, n: int) -> list[Path]:
        """The ``n`` best segmentations as (score, ids), best first.

        A forward Viterbi pass gives each place the best score from the start. The
        backward search from the end adds it as heuristic: it is the exact score of
        the best way to complete a partial path, so the search only expands paths
        that can be completed to one of the n best. Of equal totals the one nearest to
        the start goes on first, so ties do not unfold all paths that share a total.
        """
        ending = self.arcs(text)
        ahead = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            ahead[end] = max(ahead[start] + gain for start, _, gain in ending[end])
        found: list[Path] = []
        # (minus best total without rounding errors, place, order of entry, total, score so far, pieces so far)
        queue = [(-round(ahead[-1], 6), len(text), 0, ahead[-1], 0.0, None)]
        entered = 0
        while queue and len(found) < n:
            _, place, _, total, score, tail = heapq.heappop(queue)
            if place == 0:
                ids: list[int] = []
                while tail is not None:
                    ids += tail[0]
                    tail = tail[1]
                found.append((total, tuple(ids)))
                continue
            for start, piece, gain in ending[place]:
                entered += 1
                total = ahead[start] + score + gain
                heapq.heappush(queue, (-round(total, 6), start, entered, total, score + gain, (piece, tail)))
        return found

    # The best path through many units at once.

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the best paths, one after the other, how many each unit has, the scores,
        and what the second path of each unit loses.

        Forward and backward Viterbi over all lattices, place by place. The best path
        through an arc is the sum of both, and the second best path of a unit uses an
        arc that the best one does not.
        """
        codes, sizes, (begin, piece, gain, unit, local, length), (tail, head, first, last) = self._lattice(units)
        ahead, chosen = self._sweep(tail, head, gain, local + length, first, len(codes) + len(units), begin)
        behind, _ = self._sweep(head, tail, gain, sizes[unit] - local, last, len(codes) + len(units), begin)
        on_best = np.zeros(len(begin), bool)
        place, steps = last.copy(), []
        open_ = np.arange(len(units))
        while len(open_):
            arc = chosen[place[open_]]
            on_best[arc] = True
            steps.append((open_, arc))
            place[open_] = tail[arc]
            open_ = open_[place[open_] > first[open_]]
        through = np.where(on_best, -np.inf, ahead[tail] + gain + behind[head])
        second = np.full(len(units), -np.inf)
        np.maximum.at(second, unit, through)
        scores = ahead[last]
        arcs = np.concatenate([arc for _, arc in steps[::-1]])
        owners = np.concatenate([o for o, _ in steps[::-1]])
        order = np.argsort(owners, kind="stable")
        arcs, owners = arcs[order], owners[order]
        counts = np.bincount(owners, minlength=len(units))
        ids = piece[arcs].astype(np.int32)
        for i in np.flatnonzero(ids < 0)[::-1].tolist():  # characters spelled in bytes
            spelled = self._spelled(chr(codes[begin[arcs[i]]]))
            ids = np.concatenate([ids[:i], np.array(spelled, np.int32), ids[i + 1 :]])
            counts[owners[i]] += len(spelled) - 1
        return ids, counts, scores, scores - second

    def _lattice(self, units: list[str]):
        """Characters, sizes, arcs and places of many units side by side."""
        sizes = np.array([len(u) for u in units])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(units)), sizes)
        begin, length, piece, gain = self._all_arcs(codes, owner, offsets + sizes)
        unit = owner[begin]
        local = begin - offsets[unit]
        tail = begin + unit  # a unit of n characters has n + 1 places
        first, last = offsets + np.arange(len(units)), offsets + sizes + np.arange(len(units))
        return codes, sizes, (begin, piece, gain, unit, local, length), (tail, tail + length, first, last)

    def expected(self, units: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is used over all segmentations, weighted by probability.

        In parts of 1/SHARES, rounded per arc, so that sums do not depend on order.
        """
        codes, sizes, (begin, piece, gain, unit, local, length), (tail, head, first, last) = self._lattice(units)
        places = len(codes) + len(units)
        ahead = self._sums(tail, head, gain, local + length, first, places, begin)
        behind = self._sums(head, tail, gain, sizes[unit] - local, last, places, begin)
        share = np.exp(np.minimum(0, ahead[tail] + gain + behind[head] - ahead[last][unit]))
        uses = np.rint(share * times[unit] * SHARES)
        known = piece >= 0
        return np.bincount(piece[known], uses[known], self.size)

    @staticmethod
    def _sums(source, target, gain, order, sources, places: int, ties) -> np.ndarray:
        """Log of the summed probability of all ways to each place, places in ``order``."""
        value = np.full(places, -np.inf)
        value[sources] = 0
        ranked = np.lexsort((ties, target, order))
        bounds = np.flatnonzero(np.diff(order[ranked], prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            arcs = ranked[lo:hi]
            groups = np.flatnonzero(np.diff(target[arcs], prepend=-1))
            value[target[arcs[groups]]] = np.logaddexp.reduceat(value[source[arcs]] + gain[arcs], groups)
        return value

    def _all_arcs(self, codes: np.ndarray, owner: np.ndarray, ends: np.ndarray):
        """All pieces at all places, by walking the trie from every character at once."""
        symbols = self.symbol[codes].astype(np.int64)
        start = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        limit = ends[owner]
        found = []
        for step in range(self.longest):
            inside = start + step < limit[start]
            start, node = start[inside], node[inside]
            if step == 0:
                child = self._first[symbols[start]]
                hit = child >= 0
                start, node = start[hit], child[hit]
            else:
                key = node * self._width + symbols[start + step]
                at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
                hit = self._keys[at] == key
                start, node = start[hit], self._child[at[hit]]
            ids = self._ids[node]
            piece = ids >= 0
            found.append((start[piece], np.full(piece.sum(), step + 1), ids[piece], self._scores[node[piece]]))
            if step == 0:
                covered = np.zeros(len(codes), bool)
                covered[start[piece]] = True
                alone = np.flatnonzero(~covered)
                found.append((alone, np.ones(len(alone), int), np.full(len(alone), -1), np.full(len(alone), MISSING)))
        return tuple(np.concatenate(x) for x in zip(*found))

    @staticmethod
    def _sweep(source, target, gain, order, sources, places: int, ties):
        """Best score of each place and the arc it came by, places in ``order``."""
        value = np.full(places, -np.inf)
        value[sources] = 0
        chosen = np.full(places, -1)
        ranked = np.lexsort((ties, target, order))
        bounds = np.flatnonzero(np.diff(order[ranked], prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            arcs = ranked[lo:hi]
            score = value[source[arcs]] + gain[arcs]
            groups = np.flatnonzero(np.diff(target[arcs], prepend=-1))
            most = np.maximum.reduceat(score, groups)
            spread = np.repeat(most, np.diff(groups, append=len(arcs)))
            first = np.minimum.reduceat(np.where(score == spread, np.arange(len(arcs)), len(arcs)), groups)
            value[target[arcs[groups]]] = most
            chosen[target[arcs[groups]]] = arcs[first]
        return value, chosen

    # Whole texts as chains of units.

    def split(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of some texts, the number of each unit in turn, and where the texts end.

        A unit starts with the first of some spaces, or where a character follows one that is
        neither a space nor of its class.
        """
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        joined = "".join(marked)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(m) for m in marked], dtype=np.int64)
        starts = np.zeros(len(codes) + 1, bool)
        if self.chained:
            space, kind = codes == ord(SPACE), self.char_class[codes]
            apart = (kind[1:] != kind[:-1]) | (kind[1:] == 0)
            starts[1:-1] = np.where(space[1:], ~space[:-1], ~space[:-1] & apart)
        starts[0] = starts[ends] = True
        bounds = np.flatnonzero(starts)
        if not len(codes):
            return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        widths = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)  # in UTF-8
        places = np.concatenate([[0], np.cumsum(np.add.reduceat(widths, bounds[:-1], dtype=np.int64))])
        buffers = [None, pa.py_buffer(places), pa.py_buffer(joined.encode("utf-8", "surrogatepass"))]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
        units = [u.decode("utf-8", "surrogatepass") for u in coded.dictionary.to_pylist()]
        return units, coded.indices.to_numpy().astype(np.int64), np.searchsorted(bounds, ends)

    def segment_batch(self, texts: list[str], n: int = 1) -> list[tuple[float, np.ndarray, list[Other]]]:
        """For each whole text the score and ids of its best segmentation, and the second to ``n``-th best.

        No piece crosses from one unit into the next, so the best path of a text joins
        the best paths of its units. The n best differ from it only in the n - 1 units
        whose second path loses least; the search runs on those and their paths are
        combined by score. Units recur, so their paths are kept.
        """
        units, index, units_end = self.split(texts)
        if len(self._kept.number) > CACHED_UNITS:
            self._kept = Solved()
        solved = self._kept
        unseen = [u for u in units if u not in solved.number]
        for lo in range(0, len(unseen), 20_000):
            part = unseen[lo : lo + 20_000]
            solved.add(part, *self.solve(part))
        numbers = np.fromiter(map(solved.number.__getitem__, units), np.int64, len(units))[index]
        ids = solved.paths(numbers)
        ids_end = np.concatenate([[0], np.cumsum(solved.counts[numbers])])
        scores, losses = solved.scores[numbers], solved.losses[numbers]
        results, lo = [], 0
        for hi in units_end.tolist():
            score = float(scores[lo:hi].sum())
            others = self._others(units, score, index[lo:hi], numbers[lo:hi], ids_end[lo : hi + 1], losses[lo:hi], n)
            results.append((score, ids[ids_end[lo] : ids_end[hi]], others))
            lo = hi
        if any(len(u) > LONG_UNIT for u in unseen):
            self._kept = Solved()
        return results

    def _next(self, unit: str, number: int, n: int) -> list[Path]:
        """The second to ``n``-th best segmentation of a unit: what each adds to the best score, and its ids."""
        found = self._kept.next.get((number, n))
        if found is None:
            chosen = self._kept.path(number)  # of equal totals the search may find another first
            paths = self.best(unit, n)
            found = [(p[0] - paths[0][0], p[1]) for p in paths if p[1] != chosen][: n - 1]
            self._kept.next[number, n] = found
        return found

    def _others(self, units, score: float, index, numbers, ends, losses, n: int) -> list[Other]:
        """The second to n-th best segmentation of a text, best first."""
        if n == 1 or not len(index):
            return []
        if n == 2:
            least = [int(losses.argmin())]
        else:
            least = np.arange(len(index))
            if len(index) >= n:
                least = np.flatnonzero(losses <= np.partition(losses, n - 2)[n - 2])
            least = least[np.argsort(losses[least], kind="stable")][: n - 1].tolist()
        combined: list[tuple[float, tuple]] = [(0.0, ())]
        for at in least:
            if len(combined) == n and combined[-1][0] >= -losses[at]:
                break  # neither this unit nor a later one leads to a better segmentation
            paths = self._next(units[index[at]], int(numbers[at]), n)
            options = combined + [(gain + more, (*chosen, (at, path))) for gain, chosen in combined for more, path in paths]
            options.sort(key=itemgetter(0), reverse=True)
            combined = options[:n]
        start = int(ends[0])
        return [
            (
                score + gain,
                [(int(ends[at]) - start, int(ends[at + 1] - ends[at]), path) for at, path in sorted(chosen)],
            )
            for gain, chosen in combined[1:]
        ]

    def encode_batch(self, texts: list[str], n: int = 1) -> list[list[tuple[float, np.ndarray]]]:
        """For each whole text its ``n`` best segmentations as (score, ids), best first."""
        return [
            [(score, ids), *[(other, _changed(ids, changes)) for other, changes in others]]
            for score, ids, others in self.segment_batch(texts, n)
        ]

    def encode(self, text: str, n: int = 1) -> list[tuple[float, list[int]]]:
        return [(score, ids.tolist()) for score, ids in self.encode_batch([text], n)[0]]

    def decode(self, ids) -> str:
        """The text of piece ids; ids outside the vocabulary give nothing."""
        ids = np.asarray(ids, np.int64).reshape(-1)
        return self.decode_batch([ids[(ids >= 0) & (ids < self.size)]])[0]

    def decode_batch(self, paths: list[np.ndarray]) -> list[str]:
        """The texts of lists of ids of the vocabulary."""
        ids = np.concatenate(paths).astype(np.int64)
        widths = self.widths[ids]
        ends = np.concatenate([[0], np.cumsum(widths)])
        place = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends[:-1], widths)
        data = self.pool[place].tobytes()
        bounds = ends[np.cumsum([0, *map(len, paths)])].tolist()
        parts = (data[a:b] for a, b in zip(bounds, bounds[1:]))
        return [(p[1:] if p[:1] == b" " else p).decode("utf-8", "replace") for p in parts]


def _changed(ids: np.ndarray, changes: list[Change]) -> np.ndarray:
    parts, done = [], 0
    for start, length, pieces in changes:
        parts += [ids[done:start], np.array(pieces, np.int32)]
        done = start + length
    return np.concatenate([*parts, ids[done:]])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker from a path that every executor has."""
    return Vocabulary.load(path)


@lru_cache(maxsize=2)
def _fitted(path: str, key: int, shared: Broadcast) -> Vocabulary:
    """The vocabulary with the probabilities of a broadcast, made once per Python worker."""
    return vocabulary(path).rescored(*shared.value)


def _known(path: str, shared: Broadcast | None, key: int) -> Vocabulary:
    return vocabulary(path) if shared is None else _fitted(path, key, shared)


def _count_units(rows: DataFrame, path: str) -> DataFrame:
    """(unit, n) over all whole texts."""

    def work(batches):
        counts: Counter = Counter()

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["unit", "n"])
            counts.clear()
            return made

        known = vocabulary(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                units, index, _ = known.split([t or "" for t in batch.column("text").slice(start, 512).to_pylist()])
                for unit, n in zip(units, np.bincount(index, minlength=len(units)).tolist()):
                    counts[unit] += n
                if len(counts) > FLUSH:
                    yield flush()
        if counts:
            yield flush()

    return rows.select("text").mapInArrow(work, "unit string, n bigint").groupBy("unit").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, path: str, text_col: str = "text", rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """How often the texts of ``df`` use each piece: (ids, uses), by expectation and maximisation.

    Units of all whole texts are counted once. In each round every distinct unit
    spreads its count over its segmentations by their probabilities; sums per piece,
    at most one line per piece of the vocabulary, reach the driver.
    """
    context = df.sparkSession.sparkContext
    units = _count_units(common.pick(df, text=text_col), path)
    units = cut(units.repartition(context.defaultParallelism), "units")
    shared, key, found = None, 0, (np.zeros(0, np.int64), np.zeros(0))
    for _ in range(rounds):

        def work(batches, shared=shared, key=key):
            known = _known(path, shared, key)
            uses = np.zeros(known.size)
            for batch in batches:
                names, times = batch.column("unit").to_pylist(), batch.column("n").to_numpy()
                if names:
                    uses += known.expected(names, times)
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(uses[used].astype(np.int64))], ["id", "n"])

        lines = units.mapInArrow(work, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
        found = np.array([r.id for r in lines], np.int64), np.array([r.n for r in lines], float) / SHARES
        shared = context.broadcast(found)
        key = shared._jbroadcast.id()
    return found


SCHEMA = (
    "doc_id bigint, n_pieces int, n_paths int, score double, runner_up double, pieces array<int>, round_trip boolean, "
    "others array<struct<score:double,changes:array<struct<start:int,length:int,pieces:array<int>>>>>"
)


def _lists(parts: list, values: pa.Array) -> pa.ListArray:
    """``values`` as lists of the lengths of ``parts``."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), values)


def _listed(others: list[list[Other]]) -> pa.ListArray:
    """The further segmentations of some texts as a column."""
    each = list(chain.from_iterable(others))
    changes = list(chain.from_iterable(c for _, c in each))
    pieces = [p for _, _, p in changes]
    replaced = _lists(pieces, pa.array(list(chain.from_iterable(pieces)), pa.int32()))
    places = [pa.array([c[i] for c in changes], pa.int32()) for i in (0, 1)]
    made = pa.StructArray.from_arrays([*places, replaced], ["start", "length", "pieces"])
    scores = pa.array([s for s, _ in each], pa.float64())
    return _lists(others, pa.StructArray.from_arrays([scores, _lists([c for _, c in each], made)], ["score", "changes"]))


def encode_documents(
    df: DataFrame,
    path: str,
    n: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    uses: tuple[np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """Piece ids of the best segmentation of each whole text, checked by decoding.

    Returns ``doc_id, n_pieces, n_paths`` (up to ``n`` segmentations found), ``score``
    and ``runner_up`` (scores of the best and second best, null where there is none),
    ``pieces`` and ``round_trip`` (decoding gives the text back). ``others`` holds the
    second to ``n``-th best segmentation, best first: the score, and which stretches of
    ``pieces`` (from ``start``, ``length`` pieces) it replaces by which pieces. Scores are sums of
    the pieces' natural log-probabilities, by ``uses`` or else fitted to ``df`` itself
    (see :func:`fit`); a character outside of the vocabulary is spelled in bytes.

    Null and empty texts have no pieces and score 0; decoding gives the empty text. A
    text that holds U+2581 itself decodes to a space there, so its ``round_trip`` is
    false. Equal scores are ordered by the search, which depends on the text alone.
    Rows are independent: repeated ones give repeated results, an empty table none,
    and other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared = df.sparkSession.sparkContext.broadcast(fit(df, path, text_col) if uses is None else uses)
    key = shared._jbroadcast.id()

    def work(batch: pa.RecordBatch):
        known = _known(path, shared, key)
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = [t or "" for t in part.column("text").to_pylist()]
            scores, paths, others = zip(*known.segment_batch(texts, n))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(p) for p in paths], pa.int32()),
                    pa.array([1 + len(o) for o in others], pa.int32()),
                    pa.array(scores, pa.float64()),
                    pa.array([o[0][0] if o else None for o in others], pa.float64()),
                    _lists(paths, pa.array(np.concatenate(paths))),
                    pa.array([p == t for p, t in zip(known.decode_batch(paths), texts)]),
                    _listed(others),
                ],
                ["doc_id", "n_pieces", "n_paths", "score", "runner_up", "pieces", "round_trip", "others"],
            )

    return common.arrow_map(rows, work, SCHEMA)


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """``doc_id, text`` from piece ids; null lists give empty texts."""
    rows = common.pick(df, doc_id=id_col, pieces=pieces_col)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("pieces").cast("array<int>").alias("pieces"))

    def work(batch: pa.RecordBatch):
        known = vocabulary(path)
        texts = [known.decode([i for i in ids or [] if i is not None]) for ids in batch.column("pieces").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return common.arrow_map(rows, work, "doc_id bigint, text string")
