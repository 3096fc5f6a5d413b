"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put in hash order and cut into blocks. Block k of a source with weight w may run from slot
floor(k / w) on and must have run by slot ceil((k + 1) / w); in each slot the released block of the earliest deadline
runs. With weights that are quotas of a period the schedule repeats after the period, so it is made once for one
period, a table of fixed size, and a block's slot follows from its number by arithmetic on the executors. While all
sources last, each has had its weight's share of the slots so far to within less than one block; slots of a source
that has run out are passed over.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 64
PERIOD = 1024  # slots after which the schedule repeats; weights are quotas of it
MAX_SOURCES = 512
TEMPERATURE = 0.5
CELL_ROWS = 4096  # rows ranked together


def quotas(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source per period, by largest remainder, at least one each."""
    if len(weights) > min(MAX_SOURCES, period):
        raise ValueError(f"{len(weights)} sources; the schedule holds {min(MAX_SOURCES, period)}")
    spare = period - len(weights)
    total = sum(weights.values())
    exact = {s: Fraction(w).limit_denominator(10 ** 9) * spare / Fraction(total).limit_denominator(10 ** 9)
             for s, w in weights.items()}
    out = {s: int(x) for s, x in exact.items()}
    by_rest = sorted(weights, key=lambda s: (-(exact[s] - out[s]), s))
    for s in by_rest[: spare - sum(out.values())]:
        out[s] += 1
    return {s: n + 1 for s, n in out.items()}


def period_schedule(quota: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of one period, earliest deadline first."""
    period = sum(quota.values())
    waiting = [(0, s, 0) for s in sorted(quota)]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []  # by deadline
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // quota[s]), s, k, release))
        deadline, s, k, release = heapq.heappop(ready)
        out.append((s, k, slot, release, deadline))
        if k + 1 < quota[s]:
            heapq.heappush(waiting, ((k + 1) * period // quota[s], s, k + 1))
    return out


def source_counts(docs: DataFrame) -> dict[str, int]:
    rows = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).count().limit(MAX_SOURCES + 1).collect()
    return {r["source"]: r["count"] for r in rows}


def smoothed_weights(counts: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Weights between the sources' shares (temperature 1) and equal ones (0)."""
    return {s: n ** temperature for s, n in counts.items()}


def _ranked(rows: DataFrame, largest: int) -> DataFrame:
    """Number of each row in its source by hash order; a large source is ranked in cells of its hash range."""
    cells = max(1, -(-largest // CELL_ROWS))
    rows = rows.withColumn("hash", F.conv(F.substring(F.md5(F.coalesce(
        F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint"))
    rows = rows.withColumn("cell", F.expr(f"hash * {cells}L div 4294967296L"))
    counts = rows.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    number = F.row_number().over(Window.partitionBy("source", "cell").orderBy("hash", "doc_id"))
    return rows.withColumn("number", number).join(before.drop("n"), ["source", "cell"]).select(
        "doc_id", "source", (F.col("before") + F.col("number") - 1).alias("rank"))


def schedule(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row per row of ``docs``: block, slot, release, deadline, and place in the mixed order.

    Weights not given are the sources' sizes smoothed by ``temperature``. A null source is the empty source. Every row
    is placed: sources without a given weight get the smallest one. Equal rows keep separate places. An empty table
    gives no rows. Needs ``doc_id`` and ``source``; texts are not read.
    """
    spark = docs.sparkSession
    counts = source_counts(docs)
    wanted = smoothed_weights(counts, temperature)
    if weights is not None:
        least = min(weights.values())
        wanted = {s: weights.get(s, least) for s in counts}
    quota = quotas(wanted, period) if wanted else {}
    plan = [(*row, quota[row[0]]) for row in period_schedule(quota)]
    table = spark.createDataFrame(plan, "source string, k int, slot int, release int, deadline int, quota int")
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    ranked = _ranked(rows, max(counts.values(), default=0)).withColumn("block", F.expr(f"rank div {block_rows}"))
    per_source = table.select("source", "quota").distinct()
    # Both tables are bounded: a row per source, a row per slot of one period.
    placed = ranked.join(F.broadcast(per_source), "source").withColumn("k", (F.col("block") % F.col("quota")).cast("int"))
    placed = placed.join(F.broadcast(table.drop("quota")), ["source", "k"])
    base = F.expr("block div quota") * period
    return placed.select(
        "doc_id", "source", "block", (base + F.col("slot")).alias("slot"), (base + F.col("release")).alias("release"),
        (base + F.col("deadline")).alias("deadline"),
        ((base + F.col("slot")) * block_rows + F.col("rank") % block_rows).alias("place"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in mixed order: dealt out by ranges of places and sorted in each, with their columns and no others.

    Rows are matched to their place by id; rows without an id come last.
    """
    spark = docs.sparkSession
    places = schedule(docs, **options).groupBy(F.col("doc_id").alias("__id")).agg(F.min("place").alias("__place"))
    placed = docs.join(places, docs["doc_id"] == F.col("__id"), "left")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce("__place", F.lit((1 << 62)))
    return placed.repartitionByRange(parts, order).sortWithinPartitions(order).select(*[docs[c] for c in docs.columns])
