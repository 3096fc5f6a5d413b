"""Threshold-gated scoring of an arriving queue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catalogflow.sources.writers import completed


def queue_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving below ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


class QueueScorer:
    """Collects arriving rows and scores all pending ones once there are enough.

    ``root/pending/batch=<n>`` keeps what micro-batch n brought, ``root/results/trigger=<n>``
    what was scored when it came. Everything up to the last finished trigger is retired, so
    the pending rows are a range of folders: no row is searched for or deleted. A repeated
    micro-batch overwrites its own two folders and gives the same result.
    """

    def __init__(self, spark: SparkSession, root: str, score: Callable[[DataFrame], DataFrame], threshold: int = 50):
        self.spark, self.root, self.score, self.threshold = spark, root, score, threshold

    def process(self, arrived: DataFrame, batch_id: int) -> None:
        pending, results = f"{self.root}/pending", f"{self.root}/results"
        arrived.write.mode("overwrite").parquet(f"{pending}/batch={batch_id}")
        retired = max((t for t in completed(self.spark, results, "trigger") if t < batch_id), default=-1)
        waiting = [b for b in completed(self.spark, pending, "batch") if retired < b <= batch_id]
        snapshot = self.spark.read.schema(arrived.schema).parquet(*[f"{pending}/batch={b}" for b in waiting])
        # The threshold is small; counting stops as soon as it is reached.
        if snapshot.limit(self.threshold).count() < self.threshold:
            return
        self.score(snapshot).write.mode("overwrite").parquet(f"{results}/trigger={batch_id}")

    def start(self, stream: DataFrame, every: str | None = "10 minutes") -> StreamingQuery:
        """Poll every ``every``; None takes what is there now and ends."""
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.root}/checkpoint")
        writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
        return writer.start()

    def results(self) -> DataFrame | None:
        done = completed(self.spark, f"{self.root}/results", "trigger")
        if not done:
            return None
        return self.spark.read.option("basePath", f"{self.root}/results").parquet(
            *[f"{self.root}/results/trigger={t}" for t in done]
        )

    def pending(self) -> DataFrame | None:
        retired = max(completed(self.spark, f"{self.root}/results", "trigger"), default=-1)
        waiting = [b for b in completed(self.spark, f"{self.root}/pending", "batch") if b > retired]
        if not waiting:
            return None
        return self.spark.read.parquet(*[f"{self.root}/pending/batch={b}" for b in waiting])


def as_event_time(column: str):
    """A zone-less timestamp cannot carry a watermark; read it as session-zone time."""
    return F.col(column).cast("timestamp")
