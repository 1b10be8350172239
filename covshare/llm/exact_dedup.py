"""Exact duplicates by two-pass Bloom filtering, in SQL functions only.

Texts are equal when they are identical after lower-casing A-Z. The first pass
notes which filter slots two digests or more fall into; the second asks for
each row whether all its slots are among them. Rows that are not pass straight
through: their text is the only one of its kind. Only the others shuffle, and
the exact digest decides there.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.llm import bitmaps
from covshare.sources.scratch import stored


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text as hex; a null text counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha): one small row per document, written to the shared folder.

    Every later step reads these rows, so texts are read once.
    """
    return stored(
        docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("sha")),
        "digests",
    )


def copy_groups(rows: DataFrame, slots: int = bitmaps.SLOTS) -> DataFrame:
    """For rows of (id, sha): id, sha, largest and smallest id and size of the group.

    One row out per row in, repeated rows included. A null id is never the one
    that stays unless the whole group has none.
    """
    asked = bitmaps.maybe_in(rows, F.col("sha"), bitmaps.repeated(rows, "sha", slots), "maybe", slots)
    alone = asked.where("not maybe").select(
        "id", "sha", F.col("id").alias("largest"), F.col("id").alias("smallest"),
        F.lit(1).cast("long").alias("size"),
    )
    shuffled = asked.where("maybe").select("id", "sha")
    groups = shuffled.groupBy("sha").agg(
        F.max("id").alias("largest"), F.min("id").alias("smallest"), F.count(F.lit(1)).alias("size")
    )
    # A join key of its own gives both sides an exchange below the join, and so
    # lets adaptive execution split a group that holds a third of the rows.
    spread = F.xxhash64("sha", F.lit("group"))
    joined = (
        shuffled.withColumn("spread", spread)
        .join(groups.withColumn("spread", spread), ["spread", "sha"])
        .select("id", "sha", "largest", "smallest", "size")
    )
    return alone.unionByName(joined)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Null and empty texts are
    one group. Rows that repeat id and text are each returned, each kept or
    not like the other. A row with a null id stays only in a group without
    other ids (keep_id is null there). Other columns are ignored, an empty
    table gives an empty result.
    """
    groups = copy_groups(digests(docs, id_col, text_col))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.col("largest").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("largest")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns, whatever their names.

    Rows outside the filter of dropped ids pass without a shuffle. Rows that repeat
    an id are judged by their texts, one by one; of rows that repeat id and text all
    stay or none, as they can't be told apart. A row with a null id always stays.
    """
    judged = exact_duplicates(docs, id_col, text_col)
    return without_rows(docs, judged.where("not kept").select("doc_id", "text_sha256"), id_col, text_digest(docs[f"`{text_col}`"]))


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that repeat an id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def without_rows(docs: DataFrame, rows: DataFrame, id_col: str, key: Column) -> DataFrame:
    """`docs` without the rows whose id and `key` are the two columns of a row of
    `rows`; those with a null id stay. Only rows that the filter of ids lets through
    shuffle, and only theirs have the key worked out."""
    gone = stored(rows.toDF("gone", "gone_key").distinct(), "rows")
    packed = docs.select(
        docs[f"`{id_col}`"].alias("id"), F.struct(key.alias("key")).alias("of"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    )
    asked = bitmaps.maybe_in(packed, F.col("id"), bitmaps.members(gone, "gone"), "maybe")
    straight = asked.where("not maybe").select("row")
    tested = (
        asked.where("maybe")
        .join(gone, (F.col("id") == F.col("gone")) & (F.col("of.key") == F.col("gone_key")), "left_anti")
        .select("row")
    )
    return straight.unionByName(tested).select("row.*")
