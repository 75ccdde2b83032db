"""Similarity join and leader clustering of company names.

Two names belong together when their similarity ratio reaches a threshold.
Comparing all names with all names is never done. With ratio >= pct/100, two
names of la <= lb characters differ by at most

    k = (100 - pct) * (la + lb) div 100

edits. Cutting the shorter name into k + 1 pieces leaves at least one piece
untouched, which the longer name must hold at nearly the same place (pigeonhole
filter with position windows, as in "Pass-Join", Li et al., VLDB 2012). Names
therefore meet by an equi-join on (la, lb, piece number, piece text). Inside the
join what stands before the piece and what stands behind it must be within its part of
the budget (the paper's extension-based verification): counts of characters are compared
first, which tells apart most names that merely share a common piece, then the edits.
Names too long for that many pieces meet on their rarest q-grams instead (prefix filter,
Bayardo et al., WWW 2007). Every filter is lossless. The pairs of all pieces are dealt to the
tasks in equal shares (``pair_ranges``), so neither a common piece nor a name that
many others resemble leaves one task with more work than the others.

Clusters follow the walk "each name joins the first earlier leader that is
similar enough, else becomes a leader". Where the pieces make more pairs than
sorting them makes comparisons, the first names walk alone; all others then meet
only the leaders found, and those without one go on. Many near copies thus meet a
leader and not each other. The walk itself runs inside the connected parts of the
similarity graph, many small parts to a task.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import similarity_ratio
from ..session import cut
from .graph import connected_components
from .pair_ranges import PairRanges

# Names beyond this many characters meet on q-grams.
PIECE_LENGTH_LIMIT = 100
# Connected parts with more links than this walk in rounds over the whole cluster.
WALK_LINKS = 500_000


# Of each row that meets others: the number, text and length of its name, the place, number and
# length of the piece, the characters of the name, and those to the left and right of the piece.
_COUNTS = ["counts_0", "counts_1", "counts_2"]
_SIDE_COLUMNS = ["ord", "name", "n", "at", "i", "l", *_COUNTS, "left", "right"]
Sides = tuple[DataFrame, DataFrame]


def _budget(pct: int, total: str) -> str:
    return f"({100 - pct} * ({total}) div 100)"


def _grown(characters: str) -> str:
    """Counts of the first 0, 1, 2, ... characters, in 16 classes of characters.

    Four bits of the number belong to a class; as many are set as the class occurs, up
    to four times. So two texts differ in at most as many bits as characters must be
    inserted or deleted to turn one into the other, and a replacement counts twice.
    """
    place, last = "4 * (ascii(c) % 16)", "element_at(found, -1)"
    more = f"{last} | shiftleft({last} & shiftleft(7L, {place}), 1) | shiftleft(1L, {place})"
    return f"aggregate({characters}, array(0L), (found, c) -> concat(found, array({more})))"


def _counted(characters: str, word: int) -> str:
    """The same of all characters in 24 classes and up to eight times, for the eight classes of ``word``."""
    place = "8 * (ascii(c) % 8)"
    more = f"bits | shiftleft(bits & shiftleft(127L, {place}), 1) | shiftleft(1L, {place})"
    return f"aggregate({characters}, 0L, (bits, c) -> if(ascii(c) % 24 div 8 = {word}, {more}, bits))"


def _measured(names: DataFrame) -> DataFrame:
    """Add the length ``n`` and the counts of all, the first and the last 0 to ``n`` characters.

    Each name makes hundreds of pieces, so the names are spread over all tasks first.
    """
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    characters = "filter(split({}, ''), c -> c <> '')"
    measured = names.repartition(tasks, "ord").select(
        "ord",
        "name",
        F.length("name").alias("n"),
        *[F.expr(_counted(characters.format("name"), word)).alias(c) for word, c in enumerate(_COUNTS)],
        F.expr(_grown(characters.format("name"))).alias("first"),
        F.expr(_grown(characters.format("reverse(name)"))).alias("last"),
    )
    return cut(measured, "measured")


def _pieces(df: DataFrame, longer: bool, swaps: bool) -> DataFrame:
    """One row per piece: of the name cut into ``k + 1`` parts if it is the shorter
    one, and for the longer one at every place where such a part may lie.

    The first part free of edits whose number is ``i`` has exactly ``i`` edits
    before it, so it moves by at most ``i`` to either side, and by what the
    edits behind it leave over. Without replacements (``swaps``) it moves by an
    even or odd number of places just as ``i`` is even or odd.
    """
    cut_up = df.withColumn("i", F.expr("explode(sequence(0, k))")).withColumns(
        {
            "p": F.expr("int(i * na div (k + 1))"),
            "l": F.expr("int((i + 1) * na div (k + 1) - i * na div (k + 1))"),
        }
    )
    if longer:
        low = "greatest(-i, nb - na - k + i, -p)"
        if not swaps:
            low = f"{low} + abs({low} - i) % 2"
        cut_up = (
            cut_up.withColumns({"lo": F.expr(low), "hi": F.expr("least(i, nb - na + k - i, nb - l - p)")})
            .where("lo <= hi")
            .withColumn("s", F.expr(f"explode(sequence(lo, hi, {1 if swaps else 2}))"))
            .withColumn("at", F.expr("p + s"))
        )
    else:
        cut_up = cut_up.withColumnRenamed("p", "at")
    block = F.expr("xxhash64(na, nb, i, substring(name, at + 1, l))")
    around = [F.expr("first[at]").alias("left"), F.expr("last[n - at - l]").alias("right")]
    return cut_up.select(block.alias("block"), *_SIDE_COLUMNS[:-2], *around)


def _piece_sides(measured: DataFrame, pct: int, limit: int, swaps: bool) -> Sides:
    """Pieces of names as the shorter and as the longer of a pair."""
    base = measured.where(f"n between 1 and {limit}")
    longest = f"least({limit}, n * {200 - pct} div {pct})"
    shortest = f"int(ceil(n * {pct} / {200 - pct}))"
    budget = _budget(pct, "na + nb")
    if not swaps:  # insertions and deletions add up to an even or odd number as the lengths demand
        budget = f"{budget} - ({budget} - (nb - na)) % 2"

    def start(df: DataFrame, na: str, nb: str) -> DataFrame:
        return (
            df.withColumn("na", F.expr(na))
            .withColumn("nb", F.expr(nb))
            .withColumn("k", F.expr(f"int({budget})"))
            .where("k > 0 and nb - na <= k")
        )

    shorter = start(base, "n", f"explode(sequence(n, int(greatest(n, {longest}))))")
    longer = start(base, f"explode(sequence({shortest}, n))", "n")
    return _pieces(shorter, False, swaps), _pieces(longer, True, swaps)


def _gram_side(measured: DataFrame, frequency: DataFrame, pct: int, size: int) -> DataFrame:
    """The rarest grams of each long name, as many as the count bound asks for.

    Each edit destroys at most ``size`` grams, so two similar names share at
    least max(la, lb) + size - 1 - size * k of them. One of those is among the
    rarest (all grams - smallest bound + 1) of either name.
    """
    grams = _grams(_whole(measured), size).join(frequency, "gram")
    rarity = Window.partitionBy("ord").orderBy("uses", "gram", "copy")
    # smallest bound over admissible partners is reached by one of the extremes
    bounds = [
        f"(greatest(n, {m}) + {size - 1} - {size} * {_budget(pct, f'n + {m}')})"
        for m in (f"int(ceil(n * {pct} / {200 - pct}))", "n", f"int(n * {200 - pct} div {pct})")
    ]
    keep = f"n + {size - 1} - greatest(1, least({', '.join(bounds)}) - {size}) + 1"
    return (
        grams.withColumn("rank", F.row_number().over(rarity))
        .where(f"rank <= {keep}")
        .select(F.expr("xxhash64(gram, copy)").alias("block"), *_SIDE_COLUMNS)
    )


def _whole(measured: DataFrame) -> DataFrame:
    """Side columns of names that do not meet on a piece: all of the name is behind an empty one."""
    nothing = [F.lit(0).alias(c) for c in ("at", "i", "l")]
    return measured.select("ord", "name", "n", *nothing, *_COUNTS, F.lit(0).cast("bigint").alias("left"), F.expr("last[n]").alias("right"))


def _grams(names: DataFrame, size: int) -> DataFrame:
    """Grams of padded names, with a running number for repeats within a name."""
    pad = "\u0001" * (size - 1)
    padded = F.concat(F.lit(pad), F.col("name"), F.lit(pad))
    return (
        names.withColumn("t", padded)
        .withColumn("place", F.expr(f"explode(sequence(1, length(t) - {size - 1}))"))
        .withColumn("gram", F.expr(f"substring(t, place, {size})"))
        .withColumn("copy", F.row_number().over(Window.partitionBy("ord", "gram").orderBy("place")))
        .drop("t", "place")
    )


class NameJoin:
    """Similarity join over one set of distinct names (``ord``, ``name``).

    The similarity ratio counts insertions and deletions. ``swaps`` also finds
    pairs that are within the budget only if replacements count as one edit.
    """

    def __init__(
        self, names: DataFrame, pct: int = 90, limit: int = PIECE_LENGTH_LIMIT, swaps: bool = False
    ):
        if not 75 <= pct <= 100:
            raise ValueError("the piece and gram bounds hold for thresholds from 75 to 100 percent")
        self.pct, self.limit, self.swaps = pct, limit, swaps
        self.gram_size = min(4, max(1, -(-100 // max(1, 200 - 2 * pct)) - 1))
        # pairs whose longer name exceeds the limit have both names above this
        self._long = F.length("name") * (200 - pct) > limit * pct
        self._frequency = None
        long_names = names.where(self._long)
        if not long_names.isEmpty():
            grams = _grams(long_names, self.gram_size)
            self._frequency = cut(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")), "grams")

    def ranges(self, left: DataFrame, right: DataFrame | None = None) -> PairRanges:
        """The blocks under which every similar (left, right) pair meets, dealt to tasks."""
        left = _measured(left)
        right = left if right is None else _measured(right)
        short_l, long_l = _piece_sides(left, self.pct, self.limit, self.swaps)
        found = [(short_l, long_l)]
        if left is not right:
            short_r, long_r = _piece_sides(right, self.pct, self.limit, self.swaps)
            found = [(short_l, long_r), (short_r, long_l)]
        if self._frequency is not None:
            found.append(
                tuple(
                    _gram_side(names.where(self._long), self._frequency, self.pct, self.gram_size)
                    for names in (left, right)
                )
            )
        sides = []
        for kinds in zip(*found):
            # blocks of different kinds are kept apart by their number
            marked = [k.withColumn("block", F.xxhash64("block", F.lit(i))) for i, k in enumerate(kinds)]
            sides.append(cut(reduce(DataFrame.unionByName, marked), "pieces"))
        return PairRanges(*sides)

    def within(self, ranges: PairRanges) -> DataFrame:
        """Pairs of the blocks that are within the edit budget, each once, with their names.

        Pairs within the budget meet on a piece before which there are as many edits as
        pieces, and behind which is the rest of the edits. The counts of all characters and of
        those on either side drop most pairs that merely share a common piece; of the others
        the side with fewer edits is looked at first.
        """
        budget = _budget(self.pct, "n_a + n_b")
        behind = f"{budget} - i_a"

        def alike(counts: list[str], edits: str, longer: str) -> str:
            most = f"2 * ({edits}) - abs({longer})" if self.swaps else edits
            return " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in counts) + f" <= {most}"

        def near(a: str, b: str, edits: str) -> str:
            return f"levenshtein({a}, {b}, int({edits})) >= 0"

        left = near(*[f"substring(name_{x}, 1, at_{x})" for x in "ab"], "i_a")
        right = near(*[f"substring(name_{x}, at_{x} + l_{x} + 1)" for x in "ab"], behind)
        tests = [
            f"ord_a <> ord_b and abs(n_a - n_b) <= {budget}",
            alike(_COUNTS, budget, "n_a - n_b"),
            alike(["left"], "i_a", "at_a - at_b"),
            alike(["right"], behind, "n_a - at_a - n_b + at_b"),
            f"if(i_a <= {behind}, {left} and {right}, {right} and {left})",
        ]
        pairs = ranges.meet(" and ".join(tests))
        first = F.col("ord_a") < F.col("ord_b")
        ordered = pairs.select(
            F.greatest("ord_a", "ord_b").alias("later"),
            F.least("ord_a", "ord_b").alias("earlier"),
            F.when(first, F.col("name_b")).otherwise(F.col("name_a")).alias("later_name"),
            F.when(first, F.col("name_a")).otherwise(F.col("name_b")).alias("earlier_name"),
        )
        # few bytes per pair but much work behind: keep them spread over all tasks
        return ordered.repartition(ranges.tasks, "later", "earlier").distinct()

    def candidates(self, left: DataFrame, right: DataFrame | None = None) -> DataFrame:
        """Pairs within the edit budget, each once."""
        return self.within(self.ranges(left, right))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs that reach the similarity threshold, as (later, earlier)."""
        ratio = similarity_ratio("later_name", "earlier_name")
        return pairs.where(ratio >= self.pct / 100).select("later", "earlier")


def similar_pairs(names: DataFrame, pct: int = 90, limit: int = PIECE_LENGTH_LIMIT) -> DataFrame:
    """All pairs of names whose edit distance is within the budget of ``pct``."""
    return NameJoin(names, pct, limit, swaps=True).candidates(names)


def _walk_parts(links: pd.DataFrame) -> pd.DataFrame:
    """The sequential walk over whole connected parts, given by their links."""
    links = links.sort_values(["later", "earlier"])
    leader: dict[int, int] = {}
    for name, group in groupby(zip(links["later"], links["earlier"]), itemgetter(0)):
        # earlier names were walked before, or have no links to still earlier ones and lead
        leader[name] = next((e for _, e in group if leader.setdefault(e, e) == e), name)
    for e in links["earlier"].unique():
        leader.setdefault(e, e)
    return pd.DataFrame(list(leader.items()), columns=["ord", "leader"])


def _walk_rounds(edges: DataFrame) -> DataFrame:
    """Leader of each linked node, as (ord, leader): rounds of the sequential walk.

    A node is a member once an earlier neighbour leads, and leads once all its
    earlier neighbours are members (Blelloch, Fineman & Shun, SPAA 2012).
    """
    edges = cut(edges, "edges")
    later = edges.select(F.col("later").alias("ord")).distinct()
    fresh = cut(edges.select(F.col("earlier").alias("ord")).distinct().join(later, "ord", "left_anti"), "leaders")
    leaders, pending = [fresh], edges
    while not pending.isEmpty():
        members = cut(
            pending.join(fresh, pending["earlier"] == fresh["ord"], "left_semi")
            .select(F.col("later").alias("ord"))
            .distinct(),
            "members",
        )
        still = cut(
            pending.join(members, pending["later"] == members["ord"], "left_anti").join(
                members, F.col("earlier") == members["ord"], "left_anti"
            ),
            "pending",
        )
        undecided = pending.select(F.col("later").alias("ord")).distinct()
        fresh = cut(
            undecided.join(members, "ord", "left_anti").join(
                still.select(F.col("later").alias("ord")).distinct(), "ord", "left_anti"
            ),
            "leaders",
        )
        leaders.append(fresh)
        pending = still
    leading = reduce(DataFrame.unionByName, leaders)
    joined = (
        edges.join(leading, edges["earlier"] == leading["ord"], "left_semi")
        .groupBy(F.col("later").alias("ord"))
        .agg(F.min("earlier").alias("leader"))
    )
    return leading.select("ord", F.col("ord").alias("leader")).unionByName(joined)


def walk(links: DataFrame, walk_links: int = WALK_LINKS) -> DataFrame:
    """Leader of each linked name, as (ord, leader), from the links (later, earlier).

    A name's leader depends on its connected part alone. Parts of up to ``walk_links``
    links are packed into tasks of about as many and walked there name by name, so a
    chain of any form costs a fixed number of jobs; larger parts take rounds over
    the whole cluster.
    """
    links = cut(links, "similar")
    total = links.count()
    if total <= walk_links:  # all parts fit one task
        return links.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_walk_parts, "ord bigint, leader bigint")
    parts = connected_components(links.select(F.col("later").alias("a"), F.col("earlier").alias("b")))
    parts = parts.select(F.col("node").alias("later"), F.col("component").alias("part"))
    placed = cut(links.join(parts, "later"), "placed")
    large = cut(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > walk_links), "large")
    small = placed.join(large, "part", "left_anti")
    tasks = -(-2 * total // walk_links)
    walked = small.groupBy(F.pmod(F.xxhash64("part"), F.lit(tasks))).applyInPandas(
        _walk_parts, "ord bigint, leader bigint"
    )
    if large.isEmpty():
        return walked
    return walked.unionByName(_walk_rounds(placed.join(large, "part", "left_semi").select("later", "earlier")))


def _first_names(names: DataFrame, share: float) -> int:
    """The number up to which about ``share`` of the names, at least one, come first."""
    return names.agg(F.percentile_approx("ord", F.lit(share), F.lit(10_000))).first()[0]


def leader_clusters(
    names: DataFrame,
    pct: int = 90,
    limit: int = PIECE_LENGTH_LIMIT,
    effort: float = 1.0,
    walk_links: int = WALK_LINKS,
) -> DataFrame:
    """Cluster distinct names (``ord`` 1..n, ``name``): adds ``leader`` (its
    ``ord``) and ``leader_name``.

    A round may make ``effort`` times as many pairs as sorting its pieces makes
    comparisons. If all names left would make more, only so many of the first walk.
    """
    if pct >= 100:
        return names.select("ord", "name", F.col("ord").alias("leader"), F.col("name").alias("leader_name"))
    join = NameJoin(names, pct, limit)
    rest, parts = names, []
    while True:
        ranges = join.ranges(rest)
        allowed = effort * ranges.rows * math.log2(max(2, ranges.rows))
        if ranges.pairs <= allowed:
            parts.append(cut(walk(join.verified(join.within(ranges)), walk_links), "walked"))
            break
        last = _first_names(rest, math.sqrt(allowed / ranges.pairs))
        head, tail = rest.where(F.col("ord") <= last), rest.where(F.col("ord") > last)
        walked = cut(walk(join.verified(join.candidates(head)), walk_links), "walked")
        members = walked.where("ord <> leader").select("ord")
        leaders = cut(head.join(members, "ord", "left_anti"), "leaders")
        led = join.verified(join.candidates(leaders, tail))
        led = cut(led.groupBy(F.col("later").alias("ord")).agg(F.min("earlier").alias("leader")), "led")
        parts += [walked, led]
        rest = cut(tail.join(led, "ord", "left_anti"), "names")
        if rest.isEmpty():
            break
    assigned = reduce(DataFrame.unionByName, parts)
    lead = names.select(F.col("ord").alias("leader"), F.col("name").alias("leader_name"))
    led = names.join(assigned, "ord", "left").withColumn("leader", F.coalesce("leader", "ord"))
    return led.join(lead, "leader").select("ord", "name", "leader", "leader_name")
