"""Line deduplication by overlapping windows of three lines, in the JVM throughout.

Every three consecutive lines of a text are hashed. A window whose hash occurs before, in a text of smaller id or
earlier in the same one, is a later occurrence; its three lines are removed, and where later occurrences overlap
their lines are removed once. Occurrences that overlap the first one itself are left, so the first always stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import whole_text
from catalogflow.session import materialize

WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, pos, key) of every window with a sign other than white space; ``pos`` counts lines from 0."""
    lines = F.transform(lines_of(whole_text()), lambda x: F.struct(
        F.unhex(F.md5(x)).alias("digest"), (F.trim(x) != "").alias("full")))
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", lines.alias("lines"))
    rows = rows.where(F.size("lines") >= size)
    at = F.transform(F.sequence(F.lit(0), F.size("lines") - size), lambda i: F.struct(
        i.alias("pos"),
        F.unhex(F.md5(F.concat(*[F.get("lines", i + k)["digest"] for k in range(size)]))).alias("key"),
        _any([F.get("lines", i + k)["full"] for k in range(size)]).alias("full")))
    return rows.select("doc_id", F.explode(F.filter(at, lambda w: w["full"])).alias("w")).select(
        "doc_id", "w.pos", "w.key")


def _any(flags: list[Column]) -> Column:
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def covered(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document with lines to remove: their numbers, sorted, each once."""
    every = windows(docs, size)
    # Partial sums keep a row per window and task, however often a window occurs.
    first = every.groupBy("key").agg(
        F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("times"),
    ).where(F.col("times") > 1).select("key", "first")
    later = every.join(first, "key").where(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("pos") >= F.col("first.pos") + size))
    return later.groupBy("doc_id").agg(F.collect_set("pos").alias("starts")).select(
        "doc_id", F.array_sort(F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(
            p, p + size - 1))))).alias("gone"))


def dedup_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: lines, removed lines and the text that is left.

    Texts of fewer than three lines have no window and stay, as do rows without an id; a null text is empty. A text
    all of whose lines are removed is left empty. Rows of one id are one document: equal rows are not compared with
    each other and lose the same lines. Needs ``doc_id`` and ``text``; other columns are not read.
    """
    gone = materialize(covered(docs, size), "line-covered")
    # One plan at every size: each text is dealt out once, and the lines to remove are never broadcast.
    rows = docs.select("doc_id", whole_text().alias("text")).join(gone.hint("merge"), "doc_id", "left").select(
        "doc_id", lines_of(F.col("text")).alias("lines"), "gone")
    # Gaps between removed lines are slices: the work follows the lines, not lines times removals.
    bounds = F.concat(F.array(F.lit(-1)), F.coalesce("gone", F.array().cast("array<int>")), F.array(F.size("lines")))
    left = F.flatten(F.zip_with(
        F.slice(bounds, F.lit(1), F.size(bounds) - 1), F.slice(bounds, F.lit(2), F.size(bounds) - 1),
        lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1)))
    out = rows.select(
        "doc_id", F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("bigint").alias("n_removed"), left.alias("left"))
    return out.select("doc_id", "n_lines", "n_removed", F.array_join("left", "\n").alias("text"))
