"""Source divergence audit by run-length columns.

Every (lang, source) group has a column of smoothed term frequencies p over the vocabulary of its lang. Ordering a
column's vocabulary by its counts clusters equal counts into runs: one run per distinct count, its length the number of
terms with that count (terms absent from the group form the run of count 0). Two groups' runs, intersected, are the
classes of terms with one count in the first group and one in the second; the divergence of the pair is the sum over
those classes of f(p, q) times the class's length. Only terms present in both groups are ever intersected, in blocks of
the vocabulary; a run's terms absent from the other group follow from the run's whole length, and the run of terms
absent from both is counted, not enumerated.

Exact arithmetic throughout: p is an integer division (of longs where the product fits, else of 38-digit decimals), f in
longs (p and q never exceed 1e9 + 1, so (p - q)^2 fits), sums in decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogflow.session import materialize

# Fixed values of the audit's contract.
MIN_DOCUMENTS = 3  # a term is kept by a lang that has it in this many documents
SCALE = 1_000_000_000
TOP_TERMS = 200  # ranks reported in part ``term``
SALTS = 16  # a group's terms are ranked in this many pieces first, then the winners together
RUN_BLOCKS = 64  # pieces of a lang's vocabulary in which runs are intersected
HELD_TERMS = 500_000  # bound of the (group, term) counts a task holds before it hands them on

# UTF-8 bytes of terms: A-Z as small letters, a-z and whatever is not ASCII as they are; all others part terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("c", pa.int64()),
                     ("documents", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters outside ASCII's others, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def _term_counter(held_terms: int) -> Callable:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple, Counter] = defaultdict(Counter)
        documents: dict[tuple, Counter] = defaultdict(Counter)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            for (lang, source), counter in occurrences.items():
                having = documents[lang, source]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(counter), pa.string()), pa.array([source] * len(counter), pa.string()),
                    pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64()),
                    pa.array(map(having.__getitem__, counter), pa.int64())], schema=_COUNTS)
            occurrences.clear()
            documents.clear()
            held = 0

        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = terms(text)
                counter = occurrences[lang, source]
                held -= len(counter)
                counter.update(found)
                held += len(counter)
                documents[lang, source].update(set(found))
                if held >= held_terms:
                    yield from flush()
        yield from flush()

    return count


def term_counts(docs: DataFrame, held_terms: int = HELD_TERMS) -> DataFrame:
    """Rows (lang, source, term, c, documents) of ``docs(lang, source, text)``, not null: occurrences of a term in a
    group and rows that have it, each row of ``docs`` a document.

    Tasks add up what they read before anything is shuffled and hand it on when they hold ``held_terms`` counts, so a
    term comes once or more per task. Rows of one (term, lang) meet in one partition, which serves every grouping of
    more keys too.
    """
    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        _term_counter(held_terms), "lang string, source string, term binary, c long, documents long")
    return (rows.withColumn("term", F.col("term").cast("string")).repartition("term", "lang")
            .groupBy("term", "lang", "source").agg(F.sum("c").alias("c"), F.sum("documents").alias("documents")))


def smoothed(count: Column, total: Column, vocabulary: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 1) / (total + vocabulary)), exact for any counts."""
    of = total + vocabulary
    wide = F.call_function("div", (count + 1).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(38,0)"),
                           of.cast("decimal(38,0)"))
    return F.when(count < (1 << 63) // SCALE - 1, F.call_function("div", (count + 1) * F.lit(SCALE), of)).otherwise(wide) + 1


def divergence(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / q) for longs p, q >= 1."""
    d = p - q
    return F.call_function("div", d * d, q)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS,
          salts: int = SALTS) -> DataFrame:
    """Rows (lang, source, part, item, value long, rank int) of the audit of ``docs(text, lang, source)``.

    Null text, lang and source are ''. Every row is a document: a repeated row counts twice, towards document
    frequency too. A lang keeps the terms found in ``min_documents`` of its rows or more (its vocabulary, V terms).
    Every (lang, source) that occurs is a group, with or without terms.

    * ``pair``: for each other source of the same lang, the sum over the vocabulary of f(p, q), p this group's and
      q the other's; 0 when the lang keeps no term. All of them, ranked.
    * ``term``: each kept term the group has, with p above the lang's p (q); value f(p, q); ranks 1 to ``top_terms``.

    Ranks count from 1 within (lang, source, part), by value descending, then item in UTF-8 order; ties of both
    cannot occur, since items differ. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    base = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # Groups get numbers, in no order; written once, so that they keep them.
    groups = materialize(base.select("lang", "source").distinct()
                         .withColumn("g", F.monotonically_increasing_id()), "divergence-groups")
    # Written once: a kept term with its occurrences in its lang (lc) and in each group that has it.
    columns = materialize(
        term_counts(base).join(groups, ["lang", "source"]).groupBy("term", "lang")
        .agg(F.sum("documents").alias("documents"), F.sum("c").alias("lc"),
             F.sort_array(F.collect_list(F.struct("g", "c"))).alias("cells"))
        .where(F.col("documents") >= min_documents).select("lang", "term", "lc", "cells"), "divergence-columns")

    # Runs of equal counts per group, and with them the group's totals.
    runs = materialize(
        columns.select(F.explode("cells").alias("x")).select("x.g", "x.c")
        .groupBy("g", "c").agg(F.count(F.lit(1)).alias("length")), "divergence-runs")
    langs = columns.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lc").alias("ln"))
    sizes = runs.groupBy("g").agg(F.sum(F.col("c") * F.col("length")).alias("n"), F.sum("length").alias("present"))
    # p0 is p of an absent term, null where the lang keeps no term.
    totals = materialize(
        groups.join(sizes, "g", "left").join(langs, "lang", "left")
        .select("g", "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), "ln",
                F.coalesce("present", F.lit(0)).alias("present"))
        .withColumn("p0", F.when(F.col("v") > 0, smoothed(F.lit(0).cast("long"), F.col("n"), F.col("v")))),
        "divergence-totals")
    names = totals.select("g", "lang", "source")

    # Part term: the group's p against the lang's, for the terms the group has.
    per_term = (columns.select("term", "lc", F.explode("cells").alias("x")).select("x.g", "term", "x.c", "lc")
                .join(totals, "g")
                .select("g", F.col("term").alias("item"),
                        smoothed(F.col("c"), F.col("n"), F.col("v")).alias("p"),
                        smoothed(F.col("lc"), F.col("ln"), F.col("v")).alias("q"))
                .where(F.col("p") > F.col("q"))
                .select("g", "item", divergence(F.col("p"), F.col("q")).alias("value")))
    term_part = (_top(per_term, top_terms, salts).join(names, "g")
                 .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # Part pair. Of a pair's classes (c here, oc there) only those with neither count 0 are intersected; a class with
    # one count 0 is what they leave of the other's run, so they bring f(p, q) and take away what the whole runs and
    # the whole vocabulary below count for their terms.
    other = totals.select(F.col("g").alias("h"), "lang", F.col("source").alias("item"), F.col("n").alias("on"),
                          F.col("p0").alias("q0"))
    mine = totals.select("g", "n", "v", "p0")
    both = _intersected(columns).join(mine, "g").join(other.drop("lang", "item"), "h").select(
        "g", "h", "length", "p0", "q0", smoothed(F.col("c"), F.col("n"), F.col("v")).alias("p"),
        smoothed(F.col("oc"), F.col("on"), F.col("v")).alias("q"))
    p, q, p0, q0 = map(F.col, ("p", "q", "p0", "q0"))
    joint = _both_ways(both, divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0),
                       divergence(q, p) - divergence(q0, p) - divergence(q, p0) + divergence(q0, p0))
    pairs = totals.join(other, "lang").where(F.col("g") != F.col("h"))
    single = (runs.join(mine, "g").withColumn("p", smoothed(F.col("c"), F.col("n"), F.col("v")))
              .select("g", "p", "length").join(pairs.select("g", "h", "p0", "q0"), "g"))
    single = _both_ways(single, divergence(p, q0) - divergence(p0, q0), divergence(q0, p) - divergence(q0, p0))
    none = pairs.select("g", "h", (F.coalesce(divergence(p0, q0), F.lit(0)).cast("decimal(38,0)") * F.col("v"))
                        .alias("value"))
    sums = joint.unionByName(single).unionByName(none).groupBy("g", "h").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("g").orderBy(F.col("value").desc(), F.col("item"))
    pair_part = (sums.join(other.select("h", "item"), "h").withColumn("rank", F.row_number().over(order))
                 .join(names, "g").select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))

    return pair_part.unionByName(term_part).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"),
        F.col("rank").cast("int").alias("rank"))


def _intersected(columns: DataFrame) -> DataFrame:
    """Rows (g, h, c, oc, length): the runs of two groups of a lang, g < h, intersected.

    A lang's vocabulary is dealt into blocks by a hash of the term, and runs are intersected within each block, so the
    classes are not shuffled: a class comes once per block, with the block's share of its length.
    """
    block = F.pmod(F.xxhash64("term", "lang"), F.lit(RUN_BLOCKS)).alias("block")
    a = columns.select(block, "cells").repartition("block").select("block", "cells", F.posexplode("cells").alias("at", "a"))
    b = a.select("block", F.col("a.g").alias("g"), F.col("a.c").alias("c"),
                 F.explode(F.expr("slice(cells, at + 2, size(cells))")).alias("b"))
    return (b.select("block", "g", F.col("b.g").alias("h"), "c", F.col("b.c").alias("oc"))
            .groupBy("block", "g", "h", "c", "oc").agg(F.count(F.lit(1)).alias("length")).drop("block"))


def _both_ways(classes: DataFrame, value: Column, back: Column) -> DataFrame:
    """Sums of ``value`` times length for (g, h) and of ``back`` times length for (h, g)."""
    def total(v: Column) -> Column:
        return F.sum(v.cast("decimal(38,0)") * F.col("length"))

    sums = classes.groupBy("g", "h").agg(total(value).alias("value"), total(back).alias("back"))
    return sums.select(F.explode(F.array(
        F.struct("g", "h", "value"), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("back").alias("value")),
    )).alias("x")).select("x.g", "x.h", "x.value")


def _top(rows: DataFrame, k: int, salts: int) -> DataFrame:
    """The first ``k`` rows of each group ``g`` by value descending, then item; ranked from 1.

    Each group is ranked in ``salts`` pieces by a hash of the item first, so a group with very many terms is not
    sorted in one task; only the first ``k`` of each piece meet in the second ranking.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)))
    piece = Window.partitionBy("g", "salt").orderBy(F.col("value").desc(), F.col("item"))
    heads = salted.withColumn("r", F.row_number().over(piece)).where(F.col("r") <= k).drop("r", "salt")
    whole = Window.partitionBy("g").orderBy(F.col("value").desc(), F.col("item"))
    return heads.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
