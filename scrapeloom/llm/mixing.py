"""Sampling a corpus to target shares by iterative proportional fitting, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common

Targets = Mapping[str, float | DataFrame]


def text_form(text: str = "text") -> Column:
    """Topic of a text by its form: table, symbols, shouting, short or prose."""
    t = common.text_of(text)
    return (
        F.when(t.contains(" | "), "table")
        .when(t.contains("$$$") | t.contains("***") | t.contains("&&&"), "symbols")
        .when(t.contains("!!"), "shouting")
        .when(F.length(t) < 400, "short")
        .otherwise("prose")
    )


def word_count(text: str = "text") -> Column:
    words = F.split(common.text_of(text), common.SPACE)
    return F.size(F.filter(words, lambda w: w != "")).cast("bigint")


def target_shares(cells: DataFrame, target: float | DataFrame, dimension: str) -> DataFrame:
    """Share of tokens wanted for each value: (value, share), summing to one.

    A number is an exponent on the corpus's own shares (1 keeps them, 0 makes all
    values equal). A table (value, share) is taken as it is; values that it lacks
    have share 0, and values that the corpus lacks are left out.
    """
    supply = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens"))
    if isinstance(target, DataFrame):
        wanted = target.groupBy(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))
        raw = supply.join(wanted.agg(F.sum("share").alias("wish")), "value", "left")
        raw = raw.withColumn("wish", F.coalesce(F.col("wish").cast("double"), F.lit(0.0)))
    else:
        raw = supply.withColumn("wish", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), float(target))).otherwise(0.0))
    whole = raw.agg(F.sum("wish")).first()[0]
    share = F.col("wish") / F.lit(float(whole)) if whole else F.lit(0.0)
    return raw.select("value", "tokens", share.alias("share"))


def rake(
    cells: DataFrame, targets: Targets, sweeps: int = 40, tolerance: float = 1e-3, room: float = 0.95
) -> DataFrame:
    """Cells with the probability at which their documents are kept.

    ``cells`` has one line per combination of the dimensions with its ``tokens``. The
    budget is ``room`` times the largest number of tokens at which no value wants more
    than there is. Each sweep scales the cells of every value, one dimension after the
    other, so that the expected tokens, at probabilities of at most one, meet budget
    times share. It ends when all marginals are met to the tolerance, or, where they
    contradict each other or the cap, when two sweeps in turn come no nearer, or after
    ``sweeps``. Marginals are summed before they are shuffled, and every sweep is
    written to the shared folder.
    """
    dimensions = list(targets)
    shares = {d: cut(target_shares(cells, targets[d], d), "shares") for d in dimensions}
    limits = [s.where("share > 0").agg(F.min(F.col("tokens") / F.col("share"))).first()[0] for s in shares.values()]
    budget = room * min([x for x in limits if x is not None], default=0.0)
    state = cells
    for d in dimensions:
        wanted = shares[d].select(F.col("value").alias(d), F.col("share").alias(f"share_{d}"))
        state = state.join(wanted, d).withColumn(f"factor_{d}", F.lit(1.0))
    state = cut(state, "cells")

    def probability(scope: DataFrame) -> Column:
        product = F.lit(1.0)
        for d in dimensions:
            product = product * F.col(f"factor_{d}")
        return F.least(F.lit(1.0), product)

    before, idle = float("inf"), 0
    for _ in range(sweeps):
        for i, d in enumerate(dimensions):
            expected = state.groupBy(d, f"share_{d}").agg(F.sum(F.col("tokens") * probability(state)).alias("met"))
            ratio = F.when(F.col("met") > 0, F.col(f"share_{d}") * F.lit(float(budget)) / F.col("met")).otherwise(0.0)
            change = expected.select(d, ratio.alias("ratio"))
            state = state.join(change, d).withColumn(f"factor_{d}", F.least(F.lit(1e9), F.col(f"factor_{d}") * F.col("ratio")))
            state = state.withColumnRenamed("ratio", f"ratio_{i}")
        ratios = [f"ratio_{i}" for i in range(len(dimensions))]
        off = F.array_max(F.array(*[F.abs(F.col(r) - 1) for r in ratios]))
        state = cut(state.withColumn("off", F.when(F.col("tokens") > 0, off).otherwise(0.0)).drop(*ratios), "raked")
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        idle = idle + 1 if worst is not None and worst > 0.95 * before else 0
        if worst is None or worst <= tolerance or idle == 2:
            break
        before = worst
    return state.select(*cells.columns, probability(state).alias("probability"))


def _labels(topic: Column | None, seed: int) -> list[Column]:
    """Cell, tokens and draw of a row with ``doc_id``, ``text``, ``source`` and ``lang``."""
    return [
        common.text_of(F.col("source").cast("string")).alias("source"),
        common.text_of(F.col("lang").cast("string")).alias("lang"),
        (text_form() if topic is None else topic).alias("topic"),
        word_count().alias("tokens"),
        # the 53 highest bits of a hash, as a number from 0 to 1
        (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11) / F.lit(float(1 << 53))).alias("draw"),
    ]


def sample_to_targets(
    df: DataFrame,
    targets: Targets,
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    seed: int = 1,
    **fitting,
) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, probability, sampled`` for each row.

    ``targets`` names the wanted shares of tokens by ``source``, ``lang`` and
    ``topic`` (see :func:`target_shares`). Token weights of the cells (source, lang,
    topic) are raked to them; a document is sampled when a draw from a hash of its
    id, text and the seed falls below the probability of its cell, so a result does
    not depend on the order or partitioning of rows.

    Tokens are words; null and empty texts have none and are kept with the
    probability of their cell. Null sources and languages count as the empty text.
    Rows that repeat id and text share their draw. A value without wanted share is
    never sampled. An empty table gives no rows; other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col, source=source_col, lang=lang_col)
    labelled = rows.select("doc_id", *_labels(topic, seed))
    labelled = cut(labelled, "labelled")
    cells = labelled.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    fitted = rake(cut(cells, "counted"), targets, **fitting)
    key = F.concat_ws("\u0001", "source", "lang", "topic")
    lookup = cut(fitted.select(key.alias("cell"), "rows", "probability"), "fitted")
    found = common.join_hot(labelled.withColumn("cell", key), lookup, "cell", "rows", "doc_id")
    return found.select(
        "doc_id", "source", "lang", "topic", "tokens", "probability", (F.col("draw") < F.col("probability")).alias("sampled")
    )


def keep_sampled(
    df: DataFrame,
    targets: Targets,
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    seed: int = 1,
    **fitting,
) -> DataFrame:
    """The rows of ``df`` that :func:`sample_to_targets` samples, with all their columns.

    Each row meets the probability of its cell itself, so rows that share an id, or
    have none, are decided by their own texts.
    """
    names = df.columns
    wanted = {"doc_id": id_col, "text": text_col, "source": source_col, "lang": lang_col}
    packed = common.whole_row(df)
    packed = packed.select("row", *[F.col("row")[f"_{names.index(c)}"].alias(n) for n, c in wanted.items()])
    labelled = packed.select("row", "doc_id", *_labels(topic, seed))
    cells = labelled.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    fitted = rake(cut(cells, "counted"), targets, **fitting)
    key = F.concat_ws("\u0001", "source", "lang", "topic")
    lookup = cut(fitted.select(key.alias("cell"), "rows", "probability"), "fitted")
    found = common.join_hot(labelled.select("row", "doc_id", "draw", key.alias("cell")), lookup, "cell", "rows", "draw")
    return common.unpacked(found.where("draw < probability"), names)
