"""Exact duplicates by skew-safe combining, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common


def normalised(column: str = "text") -> Column:
    """Text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(common.text_of(column), common.SPACE, " ")


def exact_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256),
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are identical; ``keep_id`` is the
    smallest id of the group. Combining takes three stages, each of which groups by
    digest and whole text: copies inside a map task, then salted digest groups, then
    the winners of the salts. A text that a third of all rows share thus reaches a
    salted group once per map task and the last stage once per salt.

    Null texts count as empty and empty texts are equal. Rows that repeat an id and
    a text share its fate. A null id loses against any other; a group of null ids
    only has ``keep_id`` null and keeps all its rows. Texts that differ under one
    digest are told apart by their content. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = common.pick(df, doc_id=id_col, text=text_col).select("doc_id", normalised().alias("content"))
    hashed = rows.withColumn("digest", digest(F.col("content")))
    local = hashed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("digest", "content", "salt").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    classes = cut(
        salted.groupBy("digest", "content")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select("digest", "keep_id", "group_size"),
        "classes",
    )
    shared = cut(classes.groupBy("digest").count().where("count > 1").select("digest"), "shared-digests")
    lean = hashed.select("doc_id", "digest", F.sha2("content", 256).alias("text_sha256"))
    if shared.isEmpty():
        found = common.join_hot(lean, classes, "digest", "group_size", "doc_id")
    else:  # some digests stand for several texts: these are grouped by content alone
        clear = classes.join(shared, "digest", "left_anti")
        plain = common.join_hot(lean.join(shared, "digest", "left_anti"), clear, "digest", "group_size", "doc_id")
        mixed = hashed.join(shared, "digest", "left_semi").withColumn("text_sha256", F.sha2("content", 256))
        by_content = mixed.groupBy("content").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        found = plain.unionByName(mixed.join(by_content, "content").select(*plain.columns))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    It is a row with the group's smallest id; of several such rows, as of rows without
    id in a group that has none, any one. Rows are told apart by id and text, so a row
    that shares its id with a copy stays if its own text is another.
    """
    names = df.columns
    decided = exact_duplicates(df, id_col, text_col)
    fates = decided.groupBy("doc_id", "text_sha256").agg(
        F.first("kept").alias("kept"), F.count(F.lit(1)).alias("times")
    )
    fates = cut(fates.where("not kept or times > 1"), "fates")  # the others are one row each and stay
    packed = common.whole_row(df)
    digest = F.sha2(normalised(F.col("row")[f"_{names.index(text_col)}"]), 256)
    packed = packed.withColumn("key", F.struct(F.col("row")[f"_{names.index(id_col)}"].alias("id"), digest.alias("digest")))
    listed = fates.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).alias("key"), "kept")
    # whole rows are shuffled only where a bitmap says that their key may be listed
    marked = common.marked_likely(packed, F.col("key"), listed.select("key"))
    met = marked.where("_likely").drop("_likely").join(listed, "key", "left")
    met = cut(met.where("kept is null or kept"), "met")
    single = marked.where("not _likely").select("row").unionByName(met.where("kept is null").select("row"))
    repeated = met.where("kept").groupBy("key").agg(F.first("row").alias("row"))
    return common.unpacked(single.unionByName(repeated.select("row")), names)
