"""Personal data: base patterns, and contextual extraction bootstrapped from them, in the JVM throughout.

The base matches of a text are the seeds. What stands before a seed, the last two words with figures written as 0, is
a lexical pattern of the seed's kind. Patterns and instances form a graph: an edge for each distinct pair of pattern
and value seen. Round by round a pattern's score is the mean confidence of its instances for a kind, an instance's
confidence one minus the product of its patterns' doubts, and patterns that many certain instances support extract
further values: runs of letters, figures and link signs with enough figures that no base pattern took.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm import spans as sp
from catalogflow.llm.common import whole_text
from catalogflow.session import materialize

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
MIN_SEEDS = 3  # distinct seeds that must support a pattern
MIN_SCORE = 0.6  # mean confidence from which a pattern is used
MIN_DIGITS = 5  # figures of a value that only its context gives away
CONTEXT_CHARS = 64  # signs before a span in which its two context words are sought


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Checksum of card numbers: from the right every second digit doubled, less 9 above 9; the sum ends in 0."""
    signs = F.reverse(F.split(digits(value), ""))
    total = F.aggregate(F.transform(F.filter(signs, lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
    ).otherwise(c.cast("int"))), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _ip_parts(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.substring(F.lpad(F.ltrim(p, F.lit("0")), 3, "0"), 1, 3).cast("int"), F.lit(0)) <= 255))


# The patterns of the base kinds, as runs that are read once.
BASE = [
    sp.Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", hint=lambda t: t.contains("@")),
    sp.Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip_parts,
            hint=lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
    sp.Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", _luhn,
            hint=lambda t: t.rlike("[0-9](?:[ -]?[0-9]){11}")),
    sp.Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda v: F.length(digits(v)).between(9, 15), hint=lambda t: t.contains("+")),
]
OTHER = sp.Kind(
    "other",
    r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z@._%+-]{0,32}[0-9])[A-Za-z0-9@._%+-]{5,64}+(?![A-Za-z0-9@._%+-])",
    lambda v: F.length(digits(v)) >= MIN_DIGITS,
    hint=lambda t: t.rlike("[0-9](?:[A-Za-z@._%%+-]*+[0-9]){%d}" % (MIN_DIGITS - 1)),
)


def base_spans(text: Column) -> Column:
    """The base matches of all kinds, in order."""
    return sp.by_start(F.concat(*[sp.matches(text, k) for k in BASE]), KINDS)


def context(text: Column, start: Column) -> Column:
    """Last two words before a position in small letters, figures as 0; empty where there are none."""
    before = F.substring(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)).cast("int") + 1,
                         F.least(start, F.lit(CONTEXT_CHARS)).cast("int"))
    return F.lower(F.regexp_replace(F.regexp_extract(before, r"(\S+\s+\S+\s*|^\S+\s*)$", 0), "[0-9]+", "0"))


def _with_context(text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"),
        context(text, s["start"]).alias("pattern")))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: base spans, and the other values that look like identifiers, each with its context."""
    text = whole_text()
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("other", F.filter(
        sp.matches(F.col("text"), OTHER), lambda s: ~sp.overlaps(F.col("base"), s["start"], s["end"])))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.transform("base", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))).alias("base"),
        _with_context(F.col("text"), F.col("base")).alias("seeds"),
        _with_context(F.col("text"), F.col("other")).alias("other"),
    )


def trusted_patterns(scanned: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                     min_score: float = MIN_SCORE) -> DataFrame:
    """(pattern, kind, score) of the patterns that extract, from the pattern-instance graph.

    Confidence of a seed is 1 for its kind. Edges are distinct pairs, so a passage copied a million times
    supports its pattern once.
    """
    seeds = scanned.select(F.explode("seeds").alias("s"))
    others = scanned.select(F.explode("other").alias("s"))
    edges = seeds.select("s.pattern", F.xxhash64("s.value").alias("instance"), "s.kind").unionByName(
        others.select("s.pattern", F.xxhash64("s.value").alias("instance"), F.lit(None).cast("string").alias("kind")))
    edges = edges.where(F.col("pattern") != "").distinct()
    # Only patterns that some seed has can ever be used.
    seeded = edges.where(F.col("kind").isNotNull()).groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    seeded = seeded.where(F.col("seeds") >= min_seeds)
    edges = materialize(edges.join(seeded.select("pattern").distinct(), "pattern", "left_semi"), "pii-edges")
    seeded = materialize(seeded, "pii-seeded")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("instances"))
    known = edges.where(F.col("kind").isNotNull()).select("instance", "kind", F.lit(1.0).alias("confidence")).distinct()
    score = None
    for _ in range(rounds):
        mass = edges.select("pattern", "instance").distinct().join(known, "instance").groupBy("pattern", "kind").agg(
            F.sum("confidence").alias("mass"))
        score = materialize(
            mass.join(sizes, "pattern").join(seeded, ["pattern", "kind"]).select(
                "pattern", "kind", (F.col("mass") / F.col("instances")).alias("score")), "pii-patterns")
        good = score.where(F.col("score") >= min_score)
        found = edges.where(F.col("kind").isNull()).join(good.drop("kind").join(
            good.select("pattern", F.col("kind").alias("as_kind")), "pattern"), "pattern").groupBy(
            "instance", F.col("as_kind").alias("kind")).agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("confidence"))
        known = edges.where(F.col("kind").isNotNull()).select(
            "instance", "kind", F.lit(1.0).alias("confidence")).distinct().unionByName(
            found.select("instance", "kind", "confidence")).groupBy("instance", "kind").agg(
            F.max("confidence").alias("confidence"))
    return score.where(F.col("score") >= min_score)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, and all spans with those found by context.

    Null texts are empty; rows given twice are reported twice; a pattern must be supported by ``MIN_SEEDS``
    distinct values, so copies of a text alone teach nothing. Where a value fits patterns of several kinds the one
    with the best score names it, the earlier listed kind on a tie. Needs ``doc_id`` and ``text`` only.
    """
    scanned = materialize(scan(docs), "pii-scan")
    patterns = trusted_patterns(scanned).withColumn(
        "rank", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")))
    best = patterns.groupBy("pattern").agg(
        F.min_by("kind", F.struct(-F.col("score"), F.col("rank"))).alias("kind"))
    extra = scanned.select("row", F.explode("other").alias("s")).select(
        "row", "s.pattern", "s.start", "s.end", "s.value").join(best, "pattern")
    extra = extra.groupBy("row").agg(F.collect_list(F.struct("start", "end", "kind", "value")).alias("extra"))
    rows = scanned.select("row", "doc_id", "base").join(extra, "row", "left")
    every = sp.by_start(F.concat("base", F.coalesce("extra", F.array().cast(sp.SPAN))), KINDS)
    base = sp.by_start(F.col("base"), KINDS)
    return rows.select(
        "doc_id", *[sp.number_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(sp.listed(base), 256).alias("base_sha256"), sp.listed(every).alias("spans"),
        F.size(F.coalesce("extra", F.array().cast(sp.SPAN))).cast("bigint").alias("n_by_context"),
    )
