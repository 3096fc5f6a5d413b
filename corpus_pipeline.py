"""A corpus pipeline: toxicity, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogflow.llm import decontaminate, jaccard_join, mixing, token_store, toxicity
from catalogflow.llm.queries import table, tokenizer_path
from catalogflow.session import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likelier side is not toxic, by the ordinal model of the labelled ones."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity the document of smallest id."""
    return jaccard_join.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves their sources to the target weights."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of the documents in mixed order, read back.

    A table has no order that a reader could rely on, so the order is taken from the schedule, which is a function
    of the documents and the same as in the stage before.
    """
    places = materialize(mixing.schedule(docs).select("doc_id", "place"), "pipeline-places")
    places = places.groupBy("doc_id").min("place").withColumnRenamed("min(place)", "place")
    ordered = docs.select("doc_id", "text").join(places, "doc_id", "left")
    return token_store.store_and_digest(ordered, tokenizer_path(), ordered["place"])


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", remove_benchmark),
    ("mixing", mix_sources),
    ("token_store", write_tokens),
]

# The ordinal model and the token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
