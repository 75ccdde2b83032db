"""Spelling variants: words one edit apart, found by Gram matrices of blocks of letter counts.

One edit moves a word's vector of letter counts by a squared distance of at most two,
and its length by at most one. The matrix product of two blocks of count vectors gives
all their squared distances at once; only pairs at two or less are compared letter by
letter. Blocks hold words of one length and of like letters: the alphabet is dealt to a
few classes, and a block's words agree in the letters they take from each. An edit
changes these class counts in one of a few ways, so a block meets few others: itself,
those with one letter moved to another class, and those one letter longer.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
_FOLDS = 64  # letters share 64 columns of a count vector; sharing only lets more pairs through


def count_words(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 6,
    min_count: int = 5,
    spoil_every: int = 199,
) -> DataFrame:
    """``word, n``: words of ``min_length`` letters that occur ``min_count`` times or more.

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased. Where
    ``spoil_every`` divides h, the CRC-32 of ``<doc_id>:<word>``, the word first loses
    the letter at h % length. Null texts have no words, null ids count as empty text.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col)
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{min_length},}})"), F.lit(1))
    found = rows.select(common.text_of(F.col("doc_id").cast("string")).alias("doc_id"), F.explode(runs).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    found = found.select("doc_id", low.alias("word"))
    found = found.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "word").cast("binary")))
    word, at = F.col("word"), (F.col("h") % F.char_length("word")).cast("int")
    less = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.char_length("word")))
    found = found.select(F.when(F.col("h") % spoil_every == 0, less).otherwise(word).alias("word"))
    counted = found.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _class_counts(classes: int) -> Column:
    """How many letters of each class the word has."""
    length = F.char_length("word")
    return F.array(*[length - F.char_length(F.translate("word", LETTERS[i::classes], "")) for i in range(classes)])


def _moved(classes: int, less: int | None, more: int | None) -> Column:
    steps = [(i == more) - (i == less) for i in range(classes)]
    return F.array(*[F.col("cell")[i] + F.lit(d) for i, d in enumerate(steps)])


def _targets(cells: DataFrame, classes: int, block_letters: int) -> DataFrame:
    """``cell, target, own, homes, guests``: the cells whose words the words of ``cell`` visit.

    Each pair of words one edit apart meets in one place: the longer one at home, or
    the one with fewer letters of an earlier class. ``homes`` and ``guests`` are the
    blocks into which the two sides of the target are cut.
    """
    visits = [F.struct(_moved(classes, None, None).alias("target"), F.lit(True).alias("own"))]
    for j in range(classes):
        visits.append(F.struct(_moved(classes, None, j).alias("target"), F.lit(False).alias("own")))
        for i in range(j):
            moved = F.struct(_moved(classes, i, j).alias("target"), F.lit(False).alias("own"))
            visits.append(F.when(F.col("cell")[i] > 0, moved))
    links = cells.select("cell", "n", F.explode(F.array_compact(F.array(*visits))).alias("visit"))
    links = links.select("cell", "n", "visit.target", "visit.own")
    homes = cells.select(F.col("cell").alias("target"), F.col("n").alias("at_home"))
    links = links.join(homes, "target")
    guests = links.groupBy("target").agg(F.sum("n").alias("visiting"))
    letters = F.greatest(F.aggregate("target", F.lit(0), lambda a, x: a + x), F.lit(16)).cast("bigint")

    def blocks(rows: str, limit: int) -> Column:
        return F.ceil(F.col(rows) * letters / F.lit(limit)).cast("int")

    return links.join(guests, "target").select(
        "cell", "target", "own", blocks("at_home", block_letters).alias("homes"), blocks("visiting", 4 * block_letters).alias("guests")
    )


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _gram_vectors(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    kind = np.float32 if length < 2000 else np.float64  # products of counts stay exact
    at = np.arange(n)[:, None] * _FOLDS + (codes % _FOLDS)
    return np.bincount(at.ravel(), minlength=n * _FOLDS).reshape(n, _FOLDS).astype(kind)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become the row of ``b`` by replacing or dropping one letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= b.shape[1]


def near_pairs(homes: list[str], guests: list[str], rows: int = 512, pairs: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Places of all (home, guest) one edit apart, for words of one length at home and of
    one length, the same or one less, among the guests."""
    a, b = _codes(homes, len(homes[0])), _codes(guests, len(guests[0]))
    left, right = _gram_vectors(a), _gram_vectors(b)
    size = (right * right).sum(axis=1)
    found = [(np.zeros(0, np.int64),) * 2]
    for lo in range(0, len(homes), rows):
        part = left[lo : lo + rows]
        distance = size - 2 * (part @ right.T)
        distance += (part * part).sum(axis=1)[:, None]
        i, j = np.nonzero(distance <= 2)
        i += lo
        for at in range(0, len(i), pairs):
            x, y = i[at : at + pairs], j[at : at + pairs]
            good = _one_edit(a[x], b[y])
            found.append((x[good], y[good]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


_NEAR = "word string, near bigint, best_n bigint, best string"


def _meet(table: pa.Table) -> pa.Table:
    """All units of one bucket: per word the number of near words, and the most frequent of them."""
    frame = table.to_pandas().sort_values(["unit", "home", "guest", "role"], kind="stable")
    words, n = frame["word"].to_numpy(), frame["n"].to_numpy()
    role, length = frame["role"].to_numpy(), frame["length"].to_numpy()
    unit = frame.groupby(["unit", "home", "guest"], sort=False).ngroup().to_numpy()
    first = np.flatnonzero(np.diff(unit, prepend=-1))
    one, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in zip(first, [*first[1:], len(unit)]):
        at = np.arange(lo, hi)
        homes = at[role[at] == 0]
        for kind in (1, 2):
            guests = at[role[at] == kind]
            for size in np.unique(length[guests]) if len(homes) else ():
                some = guests[length[guests] == size]
                i, j = near_pairs(list(words[homes]), list(words[some]))
                i, j = homes[i], some[j]
                if kind == 2:  # both are at home here, and would be met twice
                    once = words[j] < words[i]
                    i, j = i[once], j[once]
                one += [i, j]
                other += [j, i]
    one, other = np.concatenate(one), np.concatenate(other)
    place = np.empty(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], one))
    one, other = one[order], other[order]
    start = np.flatnonzero(np.diff(one, prepend=-1))
    best = other[start]
    return pa.table(
        {
            "word": pa.array(words[one[start]], pa.string()),
            "near": pa.array(np.diff(start, append=len(one)), pa.int64()),
            "best_n": pa.array(n[best], pa.int64()),
            "best": pa.array(words[best], pa.string()),
        }
    )


def near_words(words: DataFrame, cell_words: int = 512, block_letters: int = 1 << 15, bucket_rows: int = 1 << 15) -> DataFrame:
    """``word, n_near, best_n, best`` for the words (``word, n``) with a word one edit apart.

    The letters are dealt to more classes the more words there are, by the same rule
    at every size, so that cells grow little. A cell beyond ``block_letters`` letters is
    cut into blocks, and all blocks of it meet all those of its visitors, so a task
    holds one pair of blocks at a time and buckets of about ``bucket_rows`` rows.
    """
    spark = words.sparkSession
    total = words.count()
    classes = max(1, min(16, round(math.log2(max(1, total / cell_words)) / 1.6)))
    celled = words.select("word", "n", F.char_length("word").alias("length"), _class_counts(classes).alias("cell"))
    cells = cut(celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "spelling-cells")
    targets = cut(_targets(cells, classes, block_letters), "spelling-targets")
    mark = F.xxhash64("word")

    def dealt(count: str) -> Column:
        return F.pmod(mark, F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    own = targets.where("own").select("cell", "homes", "guests")
    homes = celled.join(own, "cell").select(
        F.col("cell").alias("unit"), dealt("homes").alias("home"), each("guests").alias("guest"), F.lit(0).alias("role"), "word", "n", "length"
    )
    role = F.when(F.col("own"), 2).otherwise(1)
    guests = celled.join(targets, "cell").select(
        F.col("target").alias("unit"), each("homes").alias("home"), dealt("guests").alias("guest"), role.alias("role"), "word", "n", "length"
    )
    rows = homes.unionByName(guests).withColumn("unit", F.array_join("unit", ","))
    moves = targets.join(cells, "cell").agg(F.sum(F.col("n") * F.col("homes"))).first()[0] or 0
    buckets = max(1, -(-moves // bucket_rows))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("unit", "home", "guest"), F.lit(buckets)))
    found = rows.groupBy("bucket").applyInArrow(_meet, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def spelling_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 6,
    min_count: int = 5,
    spoil_every: int = 199,
    ratio: int = 5,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of :func:`count_words`.

    Near words differ by one inserted, dropped or replaced letter. A word's form is
    its most frequent near word, ties to the lowest, if that is ``ratio`` (over 1)
    times as frequent; its root is where the forms lead to. As counts grow by
    ``ratio`` each time, the steps are bounded by the largest count, and pointers
    that double their reach need the logarithm of that.

    Words without near words have ``n_near`` 0 and are their own root. Null and
    empty texts add nothing; repeated rows count again; an empty table gives no rows;
    other columns are ignored.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = cut(count_words(df, id_col, text_col, min_length, min_count, spoil_every), "spelling-words")
    near = cut(near_words(words), "spelling-near")
    known = words.join(near, "word", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    known = known.select(
        "word",
        F.when(has_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    links = cut(known.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    most = words.agg(F.max("n")).first()[0] or min_count
    steps = 1 + int(math.log(max(1, most / min_count)) / math.log(ratio))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return known.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
