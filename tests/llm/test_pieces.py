"""The n best segmentations of whole texts, and the cut into units."""

import itertools
import random
import re

import numpy as np

from scrapeloom.llm import pieces
from scrapeloom.llm.queries import PIECES, QUERIES


def small_vocabulary():
    texts = ["▁", "▁▁", "a", "b", "ab", "▁a", "▁ab", "ba", "1", "2", "12", "é"]
    scores = {t: (256 + i, -1.0 - i / 4) for i, t in enumerate(texts)}
    return pieces.Vocabulary(scores, list(range(256)), 256 + len(texts))


def all_paths(known, text):
    if not text:
        yield 0.0, ()
    for end in range(1, min(len(text), known.longest) + 1):
        piece = known.pieces.get(text[:end])
        if piece or end == 1:
            ids, gain = ((piece[0],), piece[1]) if piece else (known._spelled(text[0]), pieces.MISSING)
            for score, rest in all_paths(known, text[end:]):
                yield gain + score, ids + rest


def test_n_best_of_chains_with_ties():
    """All of many segmentations, also where units recur and totals tie."""
    known = small_vocabulary()
    for text in ("ab ab", "abab12", "aba  ba", "é a1", "?ab"):
        paths = sorted(all_paths(known, pieces.SPACE + text.replace(" ", pieces.SPACE)), key=lambda p: -p[0])
        for n in (2, 3, 8, 20):
            best = known.encode(text, n)
            assert np.allclose([s for s, _ in best], [s for s, _ in paths[:n]])
            assert len({tuple(i) for _, i in best}) == len(best)
            assert all(any(tuple(i) == p and abs(s - t) < 1e-9 for t, p in paths) for s, i in best)


def test_units():
    """A unit is some spaces with a run of one class, or with a character of none."""
    known = small_vocabulary()
    rng = random.Random(4)
    texts = ["".join(rng.choice(" ab12é?\n▁") for _ in range(rng.randrange(12))) for _ in range(400)]
    unit = re.compile("▁*(?:[ab]+|[12]+|.)|▁+", re.DOTALL)
    expected = [unit.findall(pieces.SPACE + t.replace(" ", pieces.SPACE)) if t else [] for t in texts]
    units, index, ends = known.split(texts)
    assert len(set(units)) == len(units)
    assert [[units[i] for i in index[a:b]] for a, b in itertools.pairwise([0, *ends.tolist()])] == expected
    assert known.split(["", ""])[0] == [] and known.split([])[2].tolist() == []


def test_query_searches_beyond_the_runner_up(spark, sf_dir):
    """The search decides several segmentations of each text, in several of its units."""
    rows = QUERIES["op10_pieces"](spark, sf_dir).where("n_pieces > 100").limit(50).collect()
    known = pieces.vocabulary(PIECES)
    assert rows and all(r.n_paths == 8 and len(r.others) == 7 for r in rows)
    assert any(len({c.start for o in r.others for c in o.changes}) > 2 for r in rows)
    for r in rows:
        assert r.runner_up == r.others[0].score and r.score >= r.runner_up
        assert [o.score for o in r.others] == sorted((o.score for o in r.others), reverse=True)
        text, seen = known.decode(r.pieces), {tuple(r.pieces)}
        for o in r.others:
            ids = list(r.pieces)
            for c in reversed(o.changes):
                ids[c.start : c.start + c.length] = c.pieces
            assert known.decode(ids) == text
            seen.add(tuple(ids))
        assert len(seen) == 8
