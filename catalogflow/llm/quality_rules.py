"""Quality rules as a short-circuit cascade, in the JVM throughout.

Every document gets its base measures (words, word characters, symbols, repeated lines, words in repeated 3-word
windows) from array and string functions. Documents that pass the base rule then meet further rules in a cascade: a
``CASE WHEN`` whose branches are the rules, so that the first rule to reject a document ends its evaluation and the
costlier rules behind it never run for it.

The order of the cascade is the one estimated to reject most per unit of cost: each rule's selectivity (share of
base-passing documents it rejects) and cost (the seconds Spark needs to evaluate it on the sample, over those of the
sample's plain scan) are measured on a sample of at most ``SAMPLE_ROWS`` documents; rules are ordered by rejection per
cost, descending. The order never changes which documents are kept, only how much work is spent on them.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rule.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SAMPLE_ROWS = 2000  # documents on which the cascade's order is estimated
TIMING_RUNS = 2  # the least of this many timings is a rule's cost


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: str  # SQL over the measures and the columns ``words`` and ``lines``; true rejects


# The further rules; thresholds are parameters of the operator.
RULES = (
    Rule("mean_word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("symbol_ratio", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_word_lines"),
    Rule("letter_words", r"10 * size(filter(words, w -> w rlike '\\p{L}')) < 8 * n_words"),
    Rule("ellipsis_lines",
         r"10 * size(filter(lines, l -> l rlike '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*\\z')) > 3 * n_word_lines"),
    Rule("bullet_lines",
         r"10 * size(filter(lines, l -> l rlike '^[\\x20\\x09-\\x0D]*[-*•‣◦]')) > 9 * n_word_lines"),
)


def with_repeated_window_words(frame: DataFrame, words: str = "words") -> DataFrame:
    """``frame`` with ``n_repeat_words``: positions of ``words`` covered by a 3-word window that occurs twice or
    more in the same array, first occurrence included.

    A window is known by a 64-bit hash of its three words (two different windows of one document share a hash with
    odds of about n^2 / 2^65 for n words). Windows are sorted as (hash, position) structs, so equal windows are neighbours; a window is repeated when a
    neighbour has its text. The sorted positions of repeated windows then cover min(3, gap to the next) words each.
    No lambda reads an array from outside (neighbours are compared by zipping an array with its own shifted slice),
    and each array is a column of its own projection, so it is sorted once per document.
    """
    w = F.col(words)
    cut = F.greatest(F.size(w) - 2, F.lit(0))
    hashes = F.zip_with(F.zip_with(F.slice(w, 1, cut), F.slice(w, 2, cut), lambda x, y: F.xxhash64(x, y)),
                        F.slice(w, 3, cut), lambda h, z: F.xxhash64(h, z))
    framed = frame.withColumn(
        "_windows", F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("w"), i.alias("p")))))
    windows = F.col("_windows")
    rest = F.greatest(F.size(windows) - 1, F.lit(0))
    same = F.zip_with(F.slice(windows, 2, rest), F.slice(windows, 1, rest), lambda x, y: x["w"] == y["w"])
    no = F.array(F.lit(False))
    repeated = F.zip_with(F.concat(no, same), F.concat(same, no), lambda a, b: a | b)
    framed = framed.withColumn("_positions", F.sort_array(F.filter(
        F.zip_with(windows, repeated, lambda x, r: F.when(r, x["p"])), lambda p: p.isNotNull()))).drop("_windows")
    positions = F.col("_positions")
    m = F.size(positions)
    gaps = F.zip_with(F.slice(positions, 2, F.greatest(m - 1, F.lit(0))),
                      F.slice(positions, 1, F.greatest(m - 1, F.lit(0))), lambda b, a: F.least(F.lit(3), b - a))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g) + F.when(m > 0, 3).otherwise(0)
    return framed.withColumn("n_repeat_words", covered.cast("long")).drop("_positions")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures, the base verdict and the columns ``words`` and ``lines`` the rules read.

    Null text has no words; every measure of it is 0 and it fails the base rule. Words are maximal runs of signs
    other than space and \\t \\n \\v \\f \\r; lines are split at \\n; a line counts when it holds a word.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    framed = docs.select(F.col("doc_id"), text.alias("_text"))
    # Runs of space become one space, so words are the pieces of the trimmed text and word signs its other signs.
    framed = framed.withColumn("_spaced", F.trim(F.regexp_replace("_text", f"{SPACE}+", " ")))
    split = framed.select(
        "doc_id", "_text", "_spaced",
        F.when(F.col("_spaced") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_spaced", " ")).alias("words"),
        F.filter(F.split(F.col("_text"), "\n", -1), lambda l: l.rlike(f"[^{SPACE[1:-1]}]")).alias("lines"))
    measured = split.select(
        "doc_id", "words", "lines",
        F.size("words").cast("long").alias("n_words"),
        (F.length("_spaced") - F.greatest(F.size("words") - 1, F.lit(0))).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_word_lines"))
    return with_repeated_window_words(measured).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    selectivity: float
    seconds: float

    @property
    def rejection_per_cost(self) -> float:
        return self.selectivity / max(self.seconds, 1e-3)


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Selectivity and cost of each rule on a sample of at most ``sample_rows`` documents, best first.

    The sample is a seeded Bernoulli sample of the table, cut to ``sample_rows``; only counts and timings reach the
    driver. An empty table or sample gives every rule selectivity 0 and keeps the declared order.
    """
    total = docs.count()
    if total == 0:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    sample = measures(docs.sample(fraction=min(1.0, 2.0 * sample_rows / total), seed=11).limit(sample_rows))
    sample = sample.where(~F.col("base_failed")).cache()
    try:
        passing = sample.count()
        plain = _least_time(lambda: sample.agg(F.sum("n_words")).collect())
        out = []
        for rule in rules:
            rejected = sample.agg(F.sum(F.expr(rule.rejects).cast("long"))).collect()[0][0] or 0
            spent = _least_time(lambda: sample.agg(F.sum(F.expr(rule.rejects).cast("long"))).collect())
            out.append(Estimate(rule, rejected / passing if passing else 0.0, max(spent - plain, 0.0)))
    finally:
        sample.unpersist()
    return sorted(out, key=lambda e: -e.rejection_per_cost)


def _least_time(job) -> float:
    best = float("inf")
    for _ in range(TIMING_RUNS):
        start = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - start)
    return best


def cascade(order) -> tuple[Column, Column]:
    """(kept, rejected_by) of the rules in ``order``; the first rule that rejects ends the evaluation."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return verdict.isNull(), verdict


def quality_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the base measures, the base verdict and the cascade's.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean),
    rejected_by (the base rule or the first rule of the cascade that rejects; null when kept).

    Null text counts as empty: no words, so it fails the base rule. Repeated rows and rows of null id give one row
    each, with the same verdicts for the same text. An empty table gives no rows. Other columns of ``docs`` are not
    read, so clashing names do no harm.
    """
    order = [e.rule for e in estimate(docs, rules, sample_rows)]
    kept, rejected_by = cascade(order)
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), rejected_by.alias("rejected_by"))

