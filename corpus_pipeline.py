"""From raw documents to encoded training texts, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrapeloom.llm import exact_dedup, mixing, near_join, pieces, quality_net
from scrapeloom.llm.common import table
from scrapeloom.llm.queries import BEST, MIX, PIECES
from scrapeloom.session import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject."""
    net = quality_net.train(docs, table(spark, sf_dir, "labels"))
    return quality_net.keep_good(docs, net)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that five-word n-grams link at 0.8."""
    return near_join.keep_one(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target shares by source, language and form."""
    return mixing.keep_sampled(docs, MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left."""
    return pieces.encode_documents(docs, PIECES, n=BEST)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing to target weights", mix),
    ("piece encoding", encode),
]

ORACLE_SQL = None  # the stages train models and iterate; tests check columns, ids and counts of the chain, not its rows


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
