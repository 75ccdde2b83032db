"""Licence notices by a trained paragraph classifier, scored in DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

NONE, UNKNOWN = "none", "unknown"
WORDS = "[^a-z0-9.]+"  # what parts words, in lower case
SENTENCE_END = "[.!?:;][^A-Za-z0-9]*$"
# Words that carry nothing by themselves: they count only next to another word.
PLAIN = frozenset("a all an and any are as at be by for from in is it its not of on or that the this to under with you".split())

# Wordings by family, from which the classifier is trained and which confirm it.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License, version 3.",
        "Released under the GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Released under the GPL version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Released under the LGPL version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the MPL 2.0.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
    "CC0": [
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced without prior written permission.",
    ],
    UNKNOWN: [
        "Licensed under the Example License.",
        "This work is licensed under the terms of a license agreement.",
        "Released under the Foo Public License, version 1.",
        "Use of this software is subject to the license terms of the vendor.",
        "You may redistribute this work under the terms of its license.",
        "Licensed under version 5 of the Bar License.",
    ],
}
_SA, _NC = ("sa", "sharealike", "alike"), ("nc", "noncommercial")
_ND = ("nd", "noderivatives", "noderivs", "derivatives", "derivs")
# What tells neighbours apart: groups of n-grams, one of each of which must occur, and n-grams that must not.
DECIDING: dict[str, tuple[tuple[tuple[str, ...], ...], tuple[str, ...]]] = {
    "GPL-3.0": ((("version 3", "version 3.0", "gpl 3", "gpl 3.0", "gplv3", "gpl v3", "v3"),), ("lesser", "affero", "lgpl", "agpl", "library general")),
    "GPL-2.0": ((("version 2", "version 2.0", "gpl 2", "gpl 2.0", "gplv2", "gpl v2", "v2"),), ("lesser", "affero", "lgpl", "agpl", "library general")),
    "LGPL": ((("lesser", "lgpl", "library general"),), ("affero", "agpl")),
    "AGPL-3.0": ((("affero", "agpl"), ("version 3", "version 3.0", "agpl 3", "agpl 3.0", "agplv3", "v3")), ("lesser", "lgpl")),
    "Apache-2.0": ((("apache",), ("version 2.0", "version 2", "license 2.0", "apache 2.0", "v2.0", "v2")), ("version 1.1", "version 1.0")),
    "MPL-2.0": ((("mozilla", "mpl"), ("2.0", "version 2", "v2")), ("version 1.1", "version 1.0", "v 1.1")),
    "ISC": ((("isc", "without fee", "fee"),), ()),
    "Unlicense": ((("unlicense", "unencumbered"),), ()),
    "CC0": ((("cc0",),), ()),
    "CC-BY": ((("attribution", "cc by"),), (*_SA, *_NC, *_ND)),
    "CC-BY-SA": ((_SA,), (*_NC, *_ND)),
    "CC-BY-NC": ((_NC,), (*_SA, *_ND)),
    "CC-BY-ND": ((_ND,), (*_SA, *_NC)),
    "CC-BY-NC-SA": ((_NC, _SA), _ND),
    "CC-BY-NC-ND": ((_NC, _ND), _SA),
}
# Sentences that use the same words and are no notices.
OTHER = [
    "The driver lost a license after the race.",
    "Permission to enter was refused by the guard.",
    "She is a person of public standing in general.",
    "The source of the river lies under the hills.",
    "A copy of the work was sold at auction.",
    "The software was free of charge last year.",
    "Version after version of the story was told.",
    "The terms of the peace were written in January.",
    "They met the conditions of the work in all forms.",
    "The common attribution of the painting is wrong.",
    "Rights were reserved for the nobles.",
    "The warranty of the car ended.",
    "He used the file and the binary clock.",
    "An international conference of authors was held.",
]


def grams(text: str) -> set[str]:
    """Words and pairs of neighbouring words that hold a word that carries something."""
    words = [w.strip(".") for w in re.split(WORDS, text.lower())]
    words = [w for w in words if w]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:]) if a not in PLAIN or b not in PLAIN]
    return {w for w in words if w not in PLAIN} | set(pairs)


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]
    features: tuple[str, ...]
    weights: np.ndarray  # features x families
    bias: np.ndarray

    @property
    def content(self) -> list[str]:
        """Words without one of which no feature can occur."""
        return sorted({w for f in self.features for w in f.split() if w not in PLAIN})


def _variants(text: str, rng: np.random.Generator, count: int) -> list[str]:
    """The text, shortened at random places and between words of other texts."""
    filler = "lorem ipsum dolor amet tempor labore magna aliqua".split()
    made = [text]
    for _ in range(count):
        words = [w for w in text.split() if rng.random() > 0.08] or text.split()
        before, after = (list(rng.choice(filler, rng.integers(0, 4))) for _ in range(2))
        made.append(" ".join([*before, *words, *after]))
    return made


def _probabilities(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    z = x @ weights + bias
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@lru_cache(maxsize=1)
def train(variants: int = 40, rounds: int = 400, seed: int = 5, rarity: float = 20.0) -> Classifier:
    """Logistic regression on the wordings; its temperature is set on variants held back.

    Notices of families left out of the templates are learned as ``unknown``. The
    temperature minimises the log loss of the held-back third, so probabilities can
    be read as such and an unsure notice falls to ``unknown``.
    """
    rng = np.random.default_rng(seed)
    families = (NONE, *TEMPLATES)
    texts = [(v, 0) for t in OTHER for v in _variants(t, rng, variants // 4)]
    texts += [(v, families.index(f)) for f, ts in TEMPLATES.items() for t in ts for v in _variants(t, rng, variants)]
    features = tuple(sorted({g for t in (*OTHER, *(t for ts in TEMPLATES.values() for t in ts)) for g in grams(t)}))
    at = {g: i for i, g in enumerate(features)}
    x = np.zeros((len(texts), len(features)))
    for i, (t, _) in enumerate(texts):
        x[i, [at[g] for g in grams(t) if g in at]] = 1
    y = np.eye(len(families))[[f for _, f in texts]]
    held = rng.random(len(texts)) < 1 / 3
    weights, bias = np.zeros((len(features), len(families))), np.zeros(len(families))
    for _ in range(rounds):
        slope = _probabilities(x[~held], weights, bias) - y[~held]
        weights -= 1.0 * (x[~held].T @ slope / len(slope) + 1e-4 * weights)
        bias -= 0.1 * slope.mean(axis=0)
    heats = np.linspace(0.5, 3, 26)
    loss = [-np.log((_probabilities(x[held], weights / h, bias / h) * y[held]).sum(axis=1) + 1e-12).mean() for h in heats]
    heat = heats[int(np.argmin(loss))]
    weights, bias = weights / heat, bias / heat
    # Notices are rare among paragraphs: at odds of one in ``rarity`` no notice is likelier.
    bias[0] = bias.max() + np.log(rarity)
    return Classifier(families, features, weights, bias)


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def find_licences(
    df: DataFrame,
    model: Classifier | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_probability: float = 0.5,
    least_overlap: float = 0.5,
) -> DataFrame:
    """``doc_id, n_paragraphs, notices, families`` for each row, whole text scanned.

    Paragraphs are lines, and sentences that are wrapped over neighbouring lines. A line
    that holds a content word of the classifier is scored:
    the weights of its word n-grams add up to a probability per family; any other has
    no feature, and the bias says that it is no notice. Neighbouring lines with content
    words, of which none but the last ends a sentence, are a block and also scored as
    one. A block is one notice if its family is confirmed and no line alone is confirmed
    for another, or if no line alone is confirmed; else its lines are notices.

    A notice has ``paragraph`` (its first line, from 0), ``last`` (its last line),
    ``family``, ``probability``, ``overlap`` (share of n-grams that it has
    in common with the nearest wording of the family) and ``confirmed`` (overlap of at
    least ``least_overlap``, and the n-grams that tell the family from its neighbours). ``n_paragraphs`` counts lines. A family whose probability is under
    ``least_probability`` or that no wording confirms is reported as ``unknown``.
    ``families`` lists those of the row, sorted.

    All is one narrow pass without a shuffle. Null and empty texts have one empty
    paragraph; repeated rows give repeated results, an empty table none; other
    columns are ignored.
    """
    model = model or train()
    rows = common.pick(df, doc_id=id_col, text=text_col)
    paragraphs = F.split(common.text_of(), "\n")

    def words(paragraph: Column) -> Column:
        parts = F.split(F.lower(paragraph), WORDS)
        return F.filter(F.transform(parts, lambda w: F.trim(w, F.lit("."))), lambda w: w != "")

    content, plain = _strings(model.content), _strings(sorted(PLAIN))
    lines = F.transform(
        paragraphs,
        lambda p, i: F.struct(i.alias("paragraph"), p.rlike(SENTENCE_END).alias("ended"), words(p).alias("words")),
    )
    candidates = F.filter(lines, lambda x: F.arrays_overlap(x["words"], content))

    def is_plain(word: Column) -> Column:
        return F.array_contains(plain, word)

    def grams_of(w: Column) -> Column:
        pairs = F.arrays_zip(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))).alias("a"), F.slice(w, 2, F.size(w)).alias("b"))
        kept = F.filter(pairs, lambda p: ~(is_plain(p["a"]) & is_plain(p["b"])))
        return F.array_distinct(
            F.concat(F.filter(w, lambda x: ~is_plain(x)), F.transform(kept, lambda p: F.concat_ws(" ", p["a"], p["b"])))
        )

    table = F.map_from_arrays(_strings(list(model.features)), F.array(*[_doubles(row) for row in model.weights]))
    known = _strings(list(model.features))

    def logits(g: Column) -> Column:
        used = F.array_intersect(g, known)
        return F.aggregate(
            used, _doubles(model.bias), lambda sums, f: F.zip_with(sums, F.element_at(table, f), lambda a, b: a + b)
        )

    wordings = {f: [sorted(grams(t)) for t in TEMPLATES.get(f, [])] for f in model.families}

    def overlap(g: Column, family: Column) -> Column:
        best = F.lit(0.0)
        for f, templates in wordings.items():
            if templates:
                shares = [F.size(F.array_intersect(g, _strings(t))) / F.size(F.array_union(g, _strings(t))) for t in templates]
                inside = [F.size(F.array_intersect(g, _strings(t))) / F.lit(float(len(t))) for t in templates]
                best = F.when(family == f, F.greatest(F.lit(0.0), *shares, *inside)).otherwise(best)
        return best

    def decided(g: Column, family: Column) -> Column:
        holds = F.lit(True)
        for f, (needed, barred) in DECIDING.items():
            own = ~F.arrays_overlap(g, _strings(barred))
            for group in needed:
                own = own & F.arrays_overlap(g, _strings(group))
            holds = F.when(family == f, own).otherwise(holds)
        return holds

    names = _strings(list(model.families))
    stage = rows.select("doc_id", F.size(paragraphs).alias("n_paragraphs"), candidates.alias("lines"))

    def place(x: Column) -> list[Column]:
        return [x[c].alias(c) for c in ("paragraph", "last", "block")]

    # The places in ``lines`` at which a block starts, and one behind the last.
    starts = F.filter(
        F.transform(
            "lines",
            lambda x, i: F.when(
                (i == 0)
                | F.get("lines", i - 1)["ended"]
                | (F.get("lines", i - 1)["paragraph"] + 1 != x["paragraph"]),
                i,
            ),
        ),
        lambda i: i.isNotNull(),
    )
    stage = stage.withColumn("starts", F.concat(starts, F.array(F.size("lines"))))
    blocks = F.transform(
        F.slice("starts", 1, F.size("starts") - 1),
        lambda s, k: F.slice("lines", s + 1, F.get("starts", k + 1) - s),
    )
    stage = stage.withColumn("blocks", blocks)
    alone = F.flatten(
        F.transform(
            "blocks",
            lambda b, k: F.transform(
                b, lambda x: F.struct(x["paragraph"].alias("paragraph"), x["paragraph"].alias("last"), k.alias("block"), x["words"].alias("words"))
            ),
        )
    )
    joined = F.transform(
        "blocks",
        lambda b, k: F.struct(
            F.get(b, F.lit(0))["paragraph"].alias("paragraph"),
            F.element_at(b, -1)["paragraph"].alias("last"),
            k.alias("block"),
            F.flatten(F.transform(b, lambda x: x["words"])).alias("words"),
        ),
    )
    stage = stage.withColumn("lines", F.concat(alone, F.filter(joined, lambda x: x["last"] > x["paragraph"])))
    stage = stage.withColumn("lines", F.transform("lines", lambda x: F.struct(*place(x), grams_of(x["words"]).alias("g"))))
    stage = stage.withColumn("lines", F.transform("lines", lambda x: F.struct(*place(x), x["g"].alias("g"), logits(x["g"]).alias("z"))))
    stage = stage.withColumn(
        "lines",
        F.transform(
            "lines",
            lambda x: F.struct(
                *place(x),
                x["g"].alias("g"),
                F.element_at(names, F.array_position(x["z"], F.array_max(x["z"])).cast("int")).alias("family"),
                (1.0 / F.aggregate(x["z"], F.lit(0.0), lambda s, v: s + F.exp(v - F.array_max(x["z"])))).alias("probability"),
            ),
        ),
    )
    stage = stage.withColumn("lines", F.filter("lines", lambda x: x["family"] != NONE))
    stage = stage.withColumn(
        "lines",
        F.transform(
            "lines",
            lambda x: F.struct(
                *place(x), x["family"].alias("family"), x["probability"].alias("probability"),
                overlap(x["g"], x["family"]).alias("overlap"), decided(x["g"], x["family"]).alias("decided"),
            ),
        ),
    )
    sure = lambda x: x["decided"] & (x["overlap"] >= least_overlap) & (x["probability"] >= least_probability)
    stage = stage.withColumn(
        "lines",
        F.transform(
            "lines",
            lambda x: F.struct(
                *place(x),
                F.when(sure(x), x["family"]).otherwise(UNKNOWN).alias("family"),
                x["probability"].alias("probability"),
                x["overlap"].alias("overlap"),
                (sure(x) & (x["family"] != UNKNOWN)).alias("confirmed"),
            ),
        ),
    )

    def stands(x: Column) -> Column:
        """Whether a block is a notice as a whole."""
        own = F.filter("lines", lambda y: (y["block"] == x["block"]) & (y["last"] == y["paragraph"]) & y["confirmed"])
        return (F.size(own) == 0) | (x["confirmed"] & F.forall(own, lambda y: y["family"] == x["family"]))

    whole = F.transform(F.filter("lines", lambda x: (x["last"] > x["paragraph"]) & stands(x)), lambda x: x["block"])
    stage = stage.withColumn("whole", whole)
    kept = F.filter("lines", lambda x: (x["last"] > x["paragraph"]) == F.array_contains("whole", x["block"]))
    notices = F.transform(
        F.array_sort(kept),
        lambda x: F.struct(
            x["paragraph"].cast("int").alias("paragraph"),
            x["last"].cast("int").alias("last"),
            *[x[c].alias(c) for c in ("family", "probability", "overlap", "confirmed")],
        ),
    )
    return stage.select(
        "doc_id", "n_paragraphs", notices.alias("notices"),
    ).withColumn("families", F.array_sort(F.array_distinct(F.transform("notices", lambda x: x["family"]))))
