"""Rates and gauges over event time; the same functions serve tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(length: str) -> int:
    number, unit = length.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def windowed_rate(df: DataFrame, ts: str, value: str, window: str = "1 minute", slide: str | None = None,
                  keys: tuple[str, ...] = (), watermark: str | None = None) -> DataFrame:
    """Sum of increments per second over tumbling or sliding windows.

    On a stream a watermark bounds the state; on a table it has no effect.
    """
    rows = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark and df.isStreaming:
        rows = rows.withWatermark(ts, watermark)
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    rate = (F.sum(value) / _seconds(window)).alias("rate")
    return rows.groupBy(span.alias("w"), *keys).agg(rate, F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), *keys, "rate", "n"
    )


def latest_gauge(df: DataFrame, series: str, ts: str, value: str, tie: str) -> DataFrame:
    """Newest value of each series; ties by the larger ``tie``."""
    newest = F.max_by(F.struct(F.col(ts), F.col(value)), F.struct(F.col(ts), F.col(tie)))
    return df.groupBy(series).agg(newest.alias("g")).select(
        series, F.col(f"g.{ts}").alias("at"), F.col(f"g.{value}").alias("value")
    )
