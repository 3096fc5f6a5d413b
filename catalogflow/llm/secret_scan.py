"""Secrets in texts: base patterns, and character Markov models compared by log-likelihood ratio, in the JVM throughout.

Two first-order models over the signs of a token are trained from labelled samples: values of base matches (random
strings) and words of the same texts outside them (ordinary identifiers). A token's score is the mean, over its
signs, of log P(random) - log P(ordinary); tokens above the threshold are reported as spans of kind ``markov``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm import spans as sp
from catalogflow.llm.common import whole_text
from catalogflow.session import materialize

KINDS = ["assign", "access", "hex", "markov"]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE_DOCUMENTS = 2000  # documents of each sample, those of smallest hash
SMOOTHING = 0.5
THRESHOLD = 1.0  # nats per sign

_assign_value = r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?"""
# The patterns of the base kinds.
BASE = [
    sp.Kind("assign", _assign_value + "[A-Za-z0-9+/_.=-]+",
            lambda v: F.length(F.regexp_replace(v, "^" + _assign_value, "")) >= 12, hint=lambda t: _names_secret(t)),
    sp.Kind("access", "AKIA[A-Z0-9]{14,}+", hint=lambda t: t.contains("AKIA")),
    sp.Kind("hex", "(?<![0-9a-f])[0-9a-f]{16,}+"),
]
TOKEN = sp.Kind(
    "markov", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
    lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"),
)


def _names_secret(text: Column) -> Column:
    small = F.lower(text)
    out = small.contains("password")
    for word in ["passwd", "secret", "token", "apikey", "api_key"]:
        out = out | small.contains(word)
    return out


def base_spans(text: Column) -> Column:
    return sp.by_start(F.concat(*[sp.matches(text, k) for k in BASE]), KINDS)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: base spans and the long mixed tokens that none of them touches."""
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("base", base_spans(F.col("text")))
    plain = F.transform(F.col("base"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    tokens = F.filter(sp.matches(F.col("text"), TOKEN), lambda s: ~sp.overlaps(F.col("base"), s["start"], s["end"]))
    return rows.select("doc_id", plain.alias("base"), tokens.alias("tokens"))


def _bigrams(tokens: DataFrame, label: str) -> DataFrame:
    signs = F.filter(F.split("token", ""), lambda c: c != "")
    codes = F.transform(signs, lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.transform(F.sequence(F.lit(1), F.size(codes) - 1), lambda i: F.struct(
        F.get(codes, i - 1).alias("a"), F.get(codes, i).alias("b")))
    return tokens.where(F.length("token") >= 2).select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(
        F.count(F.lit(1)).alias("n")).withColumn("label", F.lit(label))


def train(docs: DataFrame, scanned: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> list[float]:
    """Log-ratio of the two models for each pair of signs (sign 0 stands for all outside the alphabet).

    ``sample`` bounds the documents of either label; the table has a fixed size and is all that reaches the driver.
    """
    chosen = F.xxhash64(F.col("doc_id"), F.lit("secret-sample"))
    random = scanned.where(F.size("base") > 0).orderBy(chosen, "doc_id").limit(sample).select(
        F.explode("base").alias("s")).select(
        F.regexp_replace("s.value", "^" + _assign_value, "").alias("token")).distinct()
    # At most ``sample`` ids are ranked and broadcast; texts stay where they are read.
    ids = docs.select("doc_id").distinct().orderBy(chosen, "doc_id").limit(sample)
    ordinary = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id", "left_semi")
    cleared = F.col("text")
    for kind in [*BASE, TOKEN]:
        cleared = F.regexp_replace(cleared, kind.pattern, " ")
    ordinary = ordinary.select(F.explode(F.regexp_extract_all(
        cleared, F.lit("(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_]{3,}+"), F.lit(0))).alias("token"))
    size = len(ALPHABET) + 1
    counts = {"random": [0.0] * size * size, "ordinary": [0.0] * size * size}
    for row in _bigrams(random, "random").unionByName(_bigrams(ordinary, "ordinary")).collect():
        counts[row["label"]][row["a"] * size + row["b"]] = float(row["n"])
    out = []
    for a in range(size):
        total = {k: sum(v[a * size:(a + 1) * size]) + SMOOTHING * size for k, v in counts.items()}
        for b in range(size):
            p = {k: (v[a * size + b] + SMOOTHING) / total[k] for k, v in counts.items()}
            out.append(math.log(p["random"] / p["ordinary"]))
    return out


def log_ratio(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of signs; 0 for tokens of one sign."""
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in model)), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    state = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    total = F.aggregate(codes, state, lambda s, c: F.struct(
        c.alias("last"), (s["sum"] + F.when(s["last"] < 0, 0.0).otherwise(
            F.get(table, s["last"] * size + c))).alias("sum")), lambda s: s["sum"])
    return total / F.greatest(F.length(token) - 1, F.lit(1))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, and all spans with those the models add.

    Null texts are empty. Without any base match there is no sample of random strings, both models are near
    uniform on it, and hardly a token passes. Rows given twice are reported twice. Needs ``doc_id`` and ``text``.
    """
    scanned = materialize(scan(docs), "secret-scan")
    model = train(docs, scanned, sample)
    extra = F.filter("tokens", lambda s: log_ratio(s["value"], model) >= threshold)
    every = sp.by_start(F.concat("base", extra), KINDS)
    base = sp.by_start(F.col("base"), KINDS)
    return scanned.select(
        "doc_id", *[sp.number_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(sp.listed(base), 256).alias("base_sha256"), sp.listed(every).alias("spans"),
        F.size(extra).cast("bigint").alias("n_by_model"),
    )
