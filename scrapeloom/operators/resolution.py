"""Entity resolution: rows to companies by phone, else host, else similar name.

The tiers do not chain: a row without a phone is not attached to the phone
company that shares its host. Row data is reduced to one line per distinct set
of signals before anything is shuffled by company, so a company that owns a
third of all rows costs a few lines, not a third of the work of one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import contact, dates, text
from ..session import cut
from . import common, similar_names

PHONE, HOST, NAME = 1, 2, 3
TIER_NAMES = {PHONE: "phone", HOST: "host", NAME: "name"}
ROW_ORDER = ("_source_file", "_block_start", "_row_seq")


def add_signals(clean: DataFrame) -> DataFrame:
    """Add ``host``, ``normalised_name``, ``tier`` and the key within the tier."""
    rows = clean.withColumns(
        {
            "host": contact.site_host("website_clean"),
            "normalised_name": text.normalise_name("company_name"),
        }
    )
    tier = (
        F.when(F.col("phone_clean").isNotNull(), PHONE)
        .when(F.col("host").isNotNull(), HOST)
        .otherwise(NAME)
    )
    return rows.withColumns(
        {"tier": tier, "tier_key": F.coalesce("phone_clean", "host", "normalised_name")}
    )


LONELY = "\u0001"  # begins the key of a row without any signal that is a company of its own


def _single_out(signals: DataFrame, nameless: str, order: Sequence[str]) -> DataFrame:
    """Optionally give each row without any signal a key of its own."""
    if nameless == "merge":
        return signals
    own = F.concat(F.lit(LONELY), F.to_json(F.struct(*order)))
    lonely = (F.col("tier") == NAME) & (F.col("normalised_name") == "")
    return signals.withColumn("tier_key", F.when(lonely, own).otherwise(F.col("tier_key")))


def name_clusters(
    signals: DataFrame, order: Sequence[str] = ROW_ORDER, pct: int = 90, **tuning: float
) -> DataFrame:
    """Leader of each distinct name of the name tier: (tier, tier_key, leader_name).

    Names are taken in order of first appearance. Rows that were singled out have no
    name and take no part.
    """
    *outer, inner = order
    names = (
        signals.where((F.col("tier") == NAME) & ~F.col("tier_key").startswith(LONELY))
        .groupBy(F.col("tier_key").alias("name"), *outer)
        .agg(F.min(inner).alias(inner))
    )
    if outer:
        names = names.groupBy("name").agg(F.min(F.struct(*order)).alias("_first"))
    else:
        names = names.withColumnRenamed(inner, "_first")
    numbered = cut(common.dense_index(names, ["_first", "name"], "ord").select("ord", "name"), "names")
    clusters = similar_names.leader_clusters(numbered, pct, **tuning)
    return clusters.select(F.lit(NAME).alias("tier"), F.col("name").alias("tier_key"), "leader_name")


def _with_entity_key(df: DataFrame, clusters: DataFrame | None) -> DataFrame:
    """Add ``entity_key``: the tier key, or the leader's name in the name tier."""
    if clusters is None:
        return df.withColumn("entity_key", F.col("tier_key"))
    keyed = df.where(F.col("tier") != NAME).withColumn("entity_key", F.col("tier_key"))
    named = (
        df.where(F.col("tier") == NAME)
        .join(clusters, ["tier", "tier_key"], "left")
        .withColumn("entity_key", F.coalesce("leader_name", "tier_key"))
    )
    return keyed.unionByName(named.select(*keyed.columns))


def _facets(signals: DataFrame, clusters: DataFrame | None) -> DataFrame:
    """Rows and first day per company and distinct value of each signal.

    Days are kept as dates, which aggregate by hashing; texts that are no ISO
    date travel as values of their own.
    """
    odd_date = dates.odd_date("scrape_date")
    day = F.when(odd_date.isNull(), dates.iso_date("scrape_date"))
    lines = signals.groupBy(
        "tier",
        "tier_key",
        "company_name",
        "phone_clean",
        "host",
        "category",
        odd_date.alias("odd_date"),
    ).agg(F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_day"))
    facets = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"))
            for kind, column in (
                ("name", "company_name"),
                ("phone", "phone_clean"),
                ("host", "host"),
                ("category", "category"),
                ("odd_date", "odd_date"),
            )
        ]
    )
    return (
        _with_entity_key(lines, clusters)
        .select("tier", "entity_key", "rows", "first_day", F.explode(facets).alias("f"))
        .where("f.value is not null or f.kind = 'category'")
        .groupBy("tier", "entity_key", "f.kind", "f.value")
        .agg(F.sum("rows").alias("rows"), F.min("first_day").alias("first_day"))
    )


def numbered(companies: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Add ``entity_id``: the number a company has in ``registry``, or the next free ones.

    New companies follow the highest number ever given, in order of tier and key, so
    the first run numbers 1..n and later runs change no number. ``registry`` holds
    ``tier``, ``entity_key`` and ``entity_id``, one row per company.
    """
    order = ["tier", "entity_key"]
    if registry is None:
        return common.dense_index(companies, order, "entity_id")
    last = registry.agg(F.max("entity_id")).first()[0] or 0
    known = companies.join(registry.select(*order, "entity_id"), order)
    fresh = common.dense_index(companies.join(registry, order, "left_anti"), order, "entity_id")
    fresh = fresh.withColumn("entity_id", F.col("entity_id") + F.lit(last))
    return fresh.unionByName(known.select(*fresh.columns))


def extended_registry(entities: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """The registry after a run: all numbers given so far, also of companies no longer seen."""
    own = entities.select("tier", "entity_key", "entity_id")
    if registry is None:
        return own
    gone = registry.select(*own.columns).join(own, ["tier", "entity_key"], "left_anti")
    return own.unionByName(gone.select(*own.columns))


def build_entities(
    signals: DataFrame, clusters: DataFrame | None, registry: DataFrame | None = None
) -> DataFrame:
    """One line per company. The most frequent value wins, the lowest on ties.

    Three shuffles, each pre-aggregated on the map side: by full signal line,
    by company and value, by company. ``registry`` keeps earlier numbers.
    """

    def of(kind: str):
        return (F.col("kind") == kind) & F.col("value").isNotNull()

    def most_frequent(kind: str):
        return F.min_by("value", F.when(of(kind), F.struct(-F.col("rows"), F.col("value"))))

    grouped = (
        _facets(signals, clusters)
        .groupBy("tier", "entity_key")
        .agg(
            most_frequent("name").alias("canonical_name"),
            most_frequent("phone").alias("canonical_phone"),
            # at most one entry per canonical label and Unknown
            text.joined_labels(F.when(of("category"), F.col("value"))).alias("categories"),
            F.sum(F.when(F.col("kind") == "category", F.col("rows"))).alias("n_raw_rows"),
            F.least(
                F.min("first_day").cast("string"), F.min(F.when(of("odd_date"), F.col("value")))
            ).alias("first_seen"),
            F.count_if(of("phone")).alias("unique_phones"),
            F.count_if(of("host")).alias("unique_domains"),
            F.count_if(of("name")).alias("unique_names"),
        )
    )
    return numbered(grouped if registry is None else cut(grouped, "companies"), registry)


@dataclass
class Resolution:
    """Outcome of :func:`resolve`: row signals, name clusters (None for equal
    names only) and one line per company. All members are DataFrames."""

    signals: DataFrame
    clusters: DataFrame | None
    entities: DataFrame

    @property
    def entity_map(self) -> DataFrame:
        return self.entities.select(
            "entity_id", "canonical_name", "canonical_phone", "categories", "n_raw_rows", "first_seen"
        )

    @property
    def conflicts(self) -> DataFrame:
        """Companies with more than one phone, host or name."""
        return self.entities.where(
            "unique_phones > 1 or unique_domains > 1 or unique_names > 1"
        ).select(
            "entity_id", "canonical_name", "unique_phones", "unique_domains", "unique_names", "n_raw_rows"
        )

    @property
    def summary(self) -> DataFrame:
        """Rows and companies per tier and in total, with rows per company."""
        label = F.element_at(
            F.create_map(*[F.lit(x) for pair in TIER_NAMES.items() for x in pair]), F.col("tier")
        )
        by_tier = self.entities.groupBy("tier").agg(
            F.sum("n_raw_rows").alias("row_count"), F.count(F.lit(1)).alias("entity_count")
        )
        total = by_tier.agg(
            F.lit("total").alias("tier"),
            F.sum("row_count").alias("row_count"),
            F.sum("entity_count").alias("entity_count"),
        )
        both = by_tier.select(label.alias("tier"), "row_count", "entity_count").unionByName(total)
        ratio = F.col("row_count").cast("double") / F.nullif(F.col("entity_count").cast("double"), F.lit(0.0))
        return both.withColumn("dedup_ratio", F.round(ratio, 1))

    def top_entities(self, k: int = 10) -> DataFrame:
        top = self.entity_map.select(
            "entity_id", "canonical_name", "canonical_phone", "categories", "n_raw_rows"
        )
        return common.top_rows(top, "n_raw_rows", k, "entity_id")

    def assignments(self, *columns: str) -> DataFrame:
        """The clean rows with their ``entity_id``.

        Rows are the streamed side of the join: the entity side holds each key
        once, so a hot key is only split, never multiplied.
        """
        ids = self.entities.select("tier", "entity_key", "entity_id")
        rows = _with_entity_key(self.signals, self.clusters).join(ids, ["tier", "entity_key"])
        return rows.select(*columns, "tier", "entity_id") if columns else rows.drop("entity_key", "tier_key")


def signal_counts(clean: DataFrame) -> DataFrame:
    """Distinct phones, hosts and company names."""
    values = F.array(
        *[
            F.struct(F.lit(kind).alias("signal"), column.alias("value"))
            for kind, column in (
                ("phone", F.col("phone_clean")),
                ("host", contact.site_host("website_clean")),
                ("company_name", F.col("company_name")),
            )
        ]
    )
    return (
        clean.select(F.explode(values).alias("v"))
        .groupBy("v.signal")
        .agg(F.count_distinct("v.value").alias("unique_values"))
    )


def resolve(
    clean: DataFrame,
    order: Sequence[str] = ROW_ORDER,
    pct: int = 90,
    nameless: str = "merge",
    registry: DataFrame | None = None,
    **tuning: float,
) -> Resolution:
    """Resolve the written clean table to companies.

    ``order`` lists the columns that tell which row came first. ``pct`` is the
    name similarity in percent; 100 matches equal names only. ``nameless`` says
    whether rows without phone, site and name are one company (``merge``) or one
    each (``singleton``). With the ``registry`` of an earlier run its companies keep
    their numbers.
    """
    if nameless not in ("merge", "singleton"):
        raise ValueError("nameless must be 'merge' or 'singleton'")
    signals = _single_out(add_signals(clean), nameless, order)
    clusters = cut(name_clusters(signals, order, pct, **tuning), "clusters") if pct < 100 else None
    return Resolution(signals, clusters, build_entities(signals, clusters, registry))
