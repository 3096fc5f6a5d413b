"""Exact deduplication by skew-safe combining, in the JVM throughout.

1. Each task folds its own rows of equal text (the map side of the first grouping).
2. Groups of (digest, salt, text) are merged; a salt of the id spreads a text with very many copies over tasks.
3. The winners of the salts are merged to one row per (digest, text).

Every grouping has the text itself among its keys, so rows that merely share a digest never merge. A row finds its
winner by its digest where that stands for one text only, and by digest and text otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import whole_text
from catalogflow.session import materialize

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct (digest, text) of ``rows(doc_id, text, digest)``: largest id and number of rows."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    by_salt = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return by_salt.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_groups(
    docs: DataFrame,
    normalise: Callable[[Column], Column] | None = None,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per row of ``docs``: the row of its text that stays, the size of the group and the text's hash.

    Null texts are empty texts and equal to each other. Rows of equal text and equal id are one document given
    twice: both are counted and both are marked as kept when their id is the largest. A null id never wins against
    a number. ``docs`` needs ``doc_id`` and ``text``; other columns are not read. An empty table gives no rows.
    """
    text = whole_text(F.col("text"))
    text = normalise(text) if normalise else text
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("text_sha256"))
    # Written before it is joined, so that the join deals both sides out by itself and may split a hot digest.
    per_digest = materialize(winners(rows, salts).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")),
        "exact-winners")
    found = rows.select("doc_id", "digest", "text_sha256").join(
        per_digest.where(F.col("texts") == 1).drop("texts"), "digest")
    shared = per_digest.where(F.col("texts") > 1).select("digest")
    if not shared.isEmpty():
        # Different texts with one digest: these rows are told apart by their texts.
        unclear = rows.join(shared, "digest", "left_semi")
        found = found.unionByName(unclear.join(winners(unclear, salts), ["digest", "text"]).drop("text"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with their columns; equal rows of equal id stay together."""
    gone = exact_groups(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
