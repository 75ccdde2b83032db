"""Corpus operators against plain code on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scrapeloom.llm import (
    bilinear_lm,
    common,
    exact_dedup,
    licences,
    mixing,
    near_join,
    pieces,
    quality_net,
    repeats,
    sharding,
    suffix_groups,
    top_k,
)
from scrapeloom.llm.queries import MIX, ORACLES, PIECES, QUERIES
from tests import compare

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `Text` string, size int, `a.b` int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, copies, repeated rows, and columns with clashing names."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    base = " ".join(rng.choice(words) for _ in range(200))
    texts = [None, "", " \t\n", "one", "One\ttwo", "one two", base, base, base.replace(" ", "\n", 3)]
    near = base.split()
    near[7] = "changed"
    texts += [" ".join(near), " ".join(rng.choice(words) for _ in range(4000)), "x" * 900, "é" * 500 + base[:450]]
    texts += ["Licensed under the MIT License.\nthe rest", "All rights reserved."]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", 0, "other", i, 1) for i, t in enumerate(texts)]
    rows += [rows[6], (None, base, "en", "s1", 0, "o", 1, 1), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def lines(df):
    return [tuple(r) for r in df.collect()]


def source(odd):
    return [(r[0], r[1] or "") for r in odd.collect()]


def shuffled(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("digest", [None, lambda c: __import__("pyspark").sql.functions.length(c).cast("string")])
def test_exact_duplicates(odd, empty, digest):
    options = {} if digest is None else {"digest": digest}  # a weak digest must not merge texts
    docs = [(i, re.sub(r"[\x20\x09-\x0d]+", " ", t)) for i, t in source(odd)]
    keep, count = {}, Counter(t for _, t in docs)
    for i, t in docs:
        known = keep.get(t)
        keep[t] = i if known is None else known if i is None else min(i, known)
    expected = [(i, keep[t], count[t], i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in docs]
    assert shuffled(lines(exact_dedup.exact_duplicates(odd, **options))) == shuffled(expected)
    assert lines(exact_dedup.exact_duplicates(empty)) == []
    assert exact_dedup.drop_duplicates(odd).columns == odd.columns


def test_repeats(odd, empty, monkeypatch):
    docs = [(i, t.encode()) for i, t in source(odd)]
    seen = Counter(t[p : p + 400] for _, t in docs for p in range(len(t) - 399))
    expected = []
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - 399):
            if seen[t[p : p + 400]] > 1:
                gone[p : p + 400] = b"\1" * 400
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        left = bytes(c for c, g in zip(t, gone) if not g)
        expected.append((i, len(t), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    for crowd in (repeats.CROWD, 1):  # the second sends all anchors to the window-by-window way
        monkeypatch.setattr(repeats, "CROWD", crowd)
        found = [(a, b, c, [tuple(s) for s in d], e) for a, b, c, d, e in lines(repeats.find_repeats(odd))]
        assert shuffled(found) == shuffled(expected)
    assert lines(repeats.find_repeats(empty)) == []


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(500):
        s = [rng.randrange(rng.choice([1, 2, 4, 30])) for _ in range(rng.randint(0, 50))] * rng.choice([1, 1, 3])
        assert suffix_groups.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_sharding(odd, empty, spark):
    names = odd.columns
    found = lines(sharding.shard_documents(odd, shards=5).select("doc_id", "size", "shard", "slot"))
    sizes = [(i, len(t.encode()) + 8) for i, t in source(odd)]
    assert shuffled((a, b) for a, b, _, _ in found) == shuffled(sizes)
    for shard in {f[2] for f in found}:
        own = sorted(f[3] for f in found if f[2] == shard)
        assert own == list(range(len(own))) and 0 <= shard < 5
    assert lines(sharding.shard_documents(empty).select("slot")) == []
    many = spark.range(20000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', repeat('x', cast(id % 90 as int))) as text")
    many = sharding.shard_documents(many, shards=7, task_bytes=20000).groupBy("shard").agg({"size": "sum", "slot": "max", "*": "count"})
    for row in many.collect():
        assert row["max(slot)"] == row["count(1)"] - 1
    loads = [r["sum(size)"] for r in many.collect()]
    assert len(loads) == 7 and max(loads) - min(loads) <= 0.003 * sum(loads) / 7 + 200
    assert names == odd.columns


def test_near_classes(odd, empty):
    docs = source(odd)
    sets = []
    for _, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", t.lower()) if x]
        sets.append({tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(docs)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    expected = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if root(j) == root(k) and docs[j][0] is not None]
        expected.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    assert shuffled(lines(near_join.link_classes(odd))) == shuffled(expected)
    assert lines(near_join.link_classes(empty)) == []
    assert near_join.keep_one(odd).columns == odd.columns


def test_near_classes_of_many_near_copies(spark):
    """A chain and a crowd of edited copies: classes equal those of all pairs."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    found = {r[0]: r[2] for r in near_join.link_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(57)} for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert found == {i: root(i) for i in sets}


def test_language_model(odd, empty):
    docs = [(i, t.encode().lower().split() + [b""]) for i, t in source(odd)]
    held = {i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in docs}
    counts = Counter(w for i, ws in docs if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = {(i, held[i], len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in docs}
    found = lines(bilinear_lm.score_documents(odd, parts=20))  # most words are joined, not broadcast
    assert {(*r[:5], round(r[5], 6)) for r in found} == expected and len(found) == len(docs)
    assert all(r[6] < 0 for r in found)
    assert lines(bilinear_lm.score_documents(empty)) == []


def test_class_probabilities_sum_to_one():
    tokens = np.arange(bilinear_lm.CLASSES)
    model = bilinear_lm.Model.fresh(tokens)
    context = np.zeros((bilinear_lm.CONTEXT, len(tokens)), np.int64)
    assert abs((10 ** bilinear_lm.log10_classes(model, tokens, context)).sum() - 1) < 1e-5


def test_language_model_sees_words_of_shared_classes(spark):
    """Beyond the first 95 words, a word predicts the next and its probabilities sum to one."""
    rng = random.Random(4)
    texts = [" ".join(f"a{k}zz b{k}zz" for k in (rng.randrange(150) for _ in range(300))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    stats = bilinear_lm.gather(bilinear_lm.count_words(df), 500_000)
    inner = stats.inner
    assert inner.has_vector.sum() == 300 - bilinear_lm.OWN  # all words have vectors
    more = bilinear_lm.Statistics(**{**vars(stats), "distinct": 4})
    assert more.inner.has_vector.sum() == 2 * bilinear_lm.GROWTH  # by the root of the vocabulary
    model = bilinear_lm.train_model(df, spark.sparkContext.broadcast(stats), stats, rounds=4)
    c = int(stats.classes[-1])
    rows = np.arange(inner.starts[c], inner.ends[c])
    context = np.zeros((bilinear_lm.CONTEXT, len(rows)), np.int64)
    assert abs((10 ** bilinear_lm.log10_words(model, inner, np.full(len(rows), c), rows, context)).sum() - 1) < 1e-5
    right, wrong = (bilinear_lm.score_documents(df.union(spark.createDataFrame([(2008, t)], df.schema)).coalesce(1), rounds=4).where("doc_id = 2008").first().score
                    for t in (" ".join(f"a{k}zz b{k}zz" for k in range(150)), " ".join(f"a{k}zz b{(k + 1) % 150}zz" for k in range(150))))
    assert right > wrong + 1  # held out; the counts of words are the same


def test_language_model_beats_its_base(spark, sf_dir):
    found = bilinear_lm.score_documents(common.table(spark, sf_dir, "documents")).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_quality(spark, odd, empty):
    documents, labels = (common.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    net = quality_net.train(documents, labels)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    found = [r for r in quality_net.score_quality(documents, net).collect() if r.held_out and r.doc_id in marks]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    right = sum(r.predicted == marks[r.doc_id] for r in found)
    assert right / len(found) > 0.9
    scores = quality_net.score_quality(odd, net).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    assert lines(quality_net.score_quality(empty, net)) == [] and lines(quality_net.keep_good(empty, net)) == []
    assert quality_net.keep_good(odd, net).columns == odd.columns


def test_quality_does_not_depend_on_neighbours():
    net = quality_net.Net.fresh()
    texts = [b"", b"abc" * 50, b"z" * 70000, b"short"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = quality_net.probability(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    alone = [quality_net.probability(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def test_licences(odd, empty):
    found = {r.doc_id: r for r in licences.find_licences(odd).collect() if r.families}
    assert [(n.paragraph, n.family, n.confirmed) for n in found[13].notices] == [(0, "MIT", True)]
    assert found[14].families == ["Proprietary"] and set(found) == {13, 14}
    assert licences.find_licences(odd).count() == odd.count() and lines(licences.find_licences(empty)) == []


def test_unknown_licence(spark):
    df = spark.createDataFrame([(1, "Released under the Quux Public License, version 1."), (2, "The driver lost a license after the race.")], "doc_id bigint, text string")
    found = {r.doc_id: r.families for r in licences.find_licences(df).collect()}
    assert found == {1: ["unknown"], 2: []}


def test_wrapped_licences(spark):
    """Notices wrapped over lines are one notice each; those on lines of their own stay apart."""
    mit = """/* Permission is hereby granted, free of charge, to any person obtaining
 * a copy of this software and associated documentation files (the "Software"),
 * to deal in the Software without restriction, including without limitation
 * the rights to use, copy, modify, merge, publish and sell copies. */"""
    bsd = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:"""
    gpl = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
    apart = "Licensed under the MIT License\nLicensed under CC BY 4.0"
    texts = [mit, bsd, f"The story ended there.\n\n{gpl}\n\nAll rights reserved.", apart]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [(n.paragraph, n.last, n.family, n.confirmed) for n in r.notices] for r in licences.find_licences(df).collect()}
    assert found[0] == [(0, 3, "MIT", True)] and found[1] == [(0, 2, "BSD", True)]
    assert found[2] == [(2, 5, "GPL-3.0", True), (7, 7, "Proprietary", True)]
    assert found[3] == [(0, 0, "MIT", True), (1, 1, "CC-BY", True)]


def test_neighbouring_licences_are_told_apart(spark):
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    texts = {
        gnu.format("", 3): "GPL-3.0", gnu.format("", 2): "GPL-2.0", gnu.format("Lesser ", 3): "LGPL", gnu.format("Affero ", 3): "AGPL-3.0",
        gnu.format("", 1): "unknown", "Licensed under the Apache License, Version 1.1.": "unknown",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
        "Licensed under the ISC License.": "ISC", "Licensed under the MIT License.": "MIT", "Licensed under CC0 1.0.": "CC0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
    }
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    texts |= {cc.format(a): b for a, b in (("", "CC-BY"), ("-ShareAlike", "CC-BY-SA"), ("-NonCommercial", "CC-BY-NC"), ("-NoDerivatives", "CC-BY-ND"), ("-NonCommercial-ShareAlike", "CC-BY-NC-SA"), ("-NonCommercial-NoDerivatives", "CC-BY-NC-ND"))}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.families for r in licences.find_licences(df).collect()}
    assert [found[i] for i in range(len(texts))] == [[f] for f in texts.values()]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = {i: rng.standard_normal(9).round(2).tolist() for i in range(300)}
    vectors |= {7: None, 8: [None] * 9, 9: [float("nan")] * 9, 10: vectors[11], 12: []}
    df = spark.createDataFrame(list(vectors.items()) + [(None, [1.0] * 9)], "vec_id bigint, embedding array<double>")
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items() if v and None not in v and not any(map(math.isnan, v))}
    expected = []
    for q in (i for i in whole if i % 100 == 0):
        best = sorted((-sum(map(int.__mul__, whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for rows in (8192, 40):
        assert shuffled(lines(top_k.exact_top_k(df, shard_rows=rows, query_rows=2))) == shuffled(expected)
    assert lines(top_k.exact_top_k(df.limit(0))) == []


def test_mixing(spark, odd, empty):
    documents = common.table(spark, "/root/testdata/sf0.01", "documents")
    found = mixing.sample_to_targets(documents, MIX).toPandas()
    found["expected"] = found.tokens * found.probability
    for dimension, exponent in MIX.items():
        by = found.groupby(dimension)[["tokens", "expected"]].sum()
        target = by.tokens**exponent / (by.tokens**exponent).sum()
        assert (by.expected / by.expected.sum() - target).abs().max() < 0.01
    assert abs(found.sampled.mean() - found.probability.mean()) < 0.05
    assert mixing.sample_to_targets(odd, MIX).count() == odd.count() and lines(mixing.sample_to_targets(empty, MIX)) == []
    assert mixing.keep_sampled(odd, MIX).columns == odd.columns


def test_pieces(odd, empty):
    known = pieces.Vocabulary.load(PIECES)

    def all_paths(text, start=0):
        if start == len(text):
            yield 0.0, ()
        for end in range(start + 1, min(len(text), start + known.longest) + 1):
            piece = known.pieces.get(text[start:end])
            if piece is None and end > start + 1:
                continue
            ids, gain = ((piece[0],), piece[1]) if piece else (known._spelled(text[start]), pieces.MISSING)
            for score, rest in all_paths(text, end):
                yield gain + score, ids + rest

    for text in ("hello wo", "a  b", "é\tx", "x. y", "🙂ab"):
        paths = sorted(all_paths(pieces.SPACE + text.replace(" ", pieces.SPACE)), key=lambda p: -p[0])
        for n in (1, 2, 5):
            best = known.encode(text, n)
            assert [s for s, _ in best] == [s for s, _ in paths[:n]]
            assert len({tuple(i) for _, i in best}) == len(best) and all((s, tuple(i)) in paths for s, i in best)
    found = pieces.encode_documents(odd, PIECES).collect()
    assert len(found) == odd.count() and all(r.round_trip for r in found)
    texts = Counter((r.doc_id, r.text) for r in pieces.decode_documents(pieces.encode_documents(odd, PIECES), PIECES).collect())
    assert texts == Counter(source(odd))
    assert lines(pieces.encode_documents(empty, PIECES)) == []


def test_piece_scores_are_log_probabilities(spark):
    """Long pieces win over their parts, about as in the model's own merges."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = pieces.Vocabulary.load(PIECES)
    assert abs(sum(math.exp(s) for _, s in known.pieces.values()) - 1) < 1e-3
    units = ["▁the", "▁an", "ab", "é"]
    expected = Counter()
    for unit, times in zip(units, (5, 2, 1, 3)):  # all segmentations, one by one
        cuts = [[unit[i:j] for i, j in itertools.pairwise((0, *c, len(unit)))] for k in range(len(unit)) for c in itertools.combinations(range(1, len(unit)), k)]
        cuts = [(c, math.exp(sum(known.pieces[p][1] for p in c))) for c in cuts if all(p in known.pieces for p in c)]
        for c, p in cuts:
            for piece in c:
                expected[known.pieces[piece][0]] += times * p / sum(q for _, q in cuts)
    found = known.expected(units, np.array([5, 2, 1, 3])) / pieces.SHARES
    assert all(abs(found[i] - expected[i]) < 0.01 for i in range(known.size))

    documents = common.table(spark, "/root/testdata/sf0.001", "documents")
    texts = ["the training of the model", "and the other information"]
    extra = documents.select("doc_id", "text").union(spark.createDataFrame(enumerate(texts, 10**9), "doc_id bigint, text string"))
    fitted = known.rescored(*pieces.fit(extra, PIECES))
    for text in texts:
        assert fitted.encode(text)[0][1] == model.encode(text)
    rows = [t for r in documents.select("text").collect()[:40] for t in (r.text or "").split("\n") if t]
    assert sum(len(fitted.encode(t)[0][1]) for t in rows) < 1.06 * sum(len(model.encode(t)) for t in rows)
    own = pieces.encode_documents(extra.where("doc_id >= 1000000000"), PIECES).collect()
    assert all(r.score > r.runner_up and r.round_trip for r in own)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == compare.sql_rows(compare.open_tables(sf_dir), ORACLES[name])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = common.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.cut(stage(spark, docs, sf_dir))
        assert docs.columns == before.columns
        assert docs.join(before, "doc_id", "left_anti").isEmpty() and 0.5 * before.count() < docs.count() <= before.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()
