"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document contains an item when it holds at least 80 % of the item's distinct five-word shingles. Items are
partitioned by the size of their shingle set, and each partition has its own sketch length k: an item's sketch are
its k shingles of smallest hash, k one more than a contained item of that partition can lack. A document that
contains the item therefore holds a sketch shingle, however long it is, and partitions whose items need more shingles
than a document shares are not searched. Candidates are verified on the shingles themselves.

Documents are reduced to the shingles that some item may hold by a bitmap of fixed size; documents that share the
same such shingles (a passage copied many times) are searched and verified once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.common import in_bitmap, key_bitmap
from catalogflow.llm.shingles import ALNUM, Words, sliced, text_buffer
from catalogflow.session import materialize

SHINGLE = 5
CONTAINMENT = 0.8
BITMAP_BITS = 1 << 24


def needed(n: int) -> int:
    """Shingles that a document must hold of an item with ``n``."""
    return -(-n * 4 // 5)


def _item_shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        words = Words(*text_buffer(batch.column(1)), ALNUM)
        hashes, inside = words.shingles(SHINGLE)
        at = np.flatnonzero(inside)
        rows = np.searchsorted(words.first, at, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(hashes[at].view(np.int64)),
             pa.array([words.text(i, SHINGLE) for i in at], type=pa.string())], names=["item_id", "hash", "shingle"])


def _document_hits(bitmap: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words = Words(*text_buffer(batch.column(1)), ALNUM)
            hashes, inside = words.shingles(SHINGLE)
            at = np.flatnonzero(inside)
            at = at[in_bitmap(bitmap, hashes[at])]
            rows = np.searchsorted(words.first, at, side="right") - 1
            found, prints, held = np.unique(rows), [], []
            for lo, hi in zip(np.searchsorted(rows, found), np.searchsorted(rows, found, side="right"), strict=True):
                shingles = sorted({words.text(i, SHINGLE) for i in at[lo:hi]})
                held.append(shingles)
                prints.append(hashlib.blake2b("\n".join(shingles).encode(), digest_size=16).digest())
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(found)), pa.array(prints, type=pa.binary()),
                     pa.array(held, type=pa.list_(pa.string()))], names=["doc_id", "held_id", "held"])

    return run


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment) of every item that a document contains.

    Words are runs of ASCII letters, figures and all signs beyond ASCII, with A-Z as a-z. Items of fewer than five
    words have no shingle and are contained nowhere; null and empty texts contain nothing. Rows given twice are
    reported twice; items of one id are one item, with the shingles of all its rows. Needs ``doc_id`` and
    ``text`` of ``docs``, ``item_id`` and ``text`` of ``items``.
    """
    shingles = materialize(items.select("item_id", "text").mapInArrow(
        _item_shingles, "item_id long, hash long, shingle string").distinct(), "leak-shingles")
    sizes = shingles.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    # Partition p holds the items of 2^p to 2^(p+1) - 1 shingles.
    sizes = sizes.withColumn("partition", F.floor(F.log2("n_item")).cast("int"))
    largest = F.expr("shiftleft(1L, partition + 1) - 1")
    sizes = sizes.withColumn("sketch", largest - F.ceil(largest * 4 / 5) + 1).withColumn(
        "needed", F.ceil(F.col("n_item") * 4 / 5))
    ranked = shingles.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("hash", "shingle")))
    sketches = ranked.join(sizes, "item_id").where(F.col("rank") <= F.col("sketch")).select("shingle", "item_id", "needed")
    bitmap = key_bitmap(shingles, "hash", BITMAP_BITS)
    hits = materialize(docs.select("doc_id", "text").mapInArrow(
        _document_hits(bitmap), "doc_id long, held_id binary, held array<string>"), "leak-hits")
    held = hits.groupBy("held_id").agg(F.first("held").alias("held"))
    probes = held.select("held_id", F.size("held").alias("n_held"), F.explode("held").alias("shingle"))
    candidates = probes.join(sketches, "shingle").where(F.col("n_held") >= F.col("needed")).select(
        "held_id", "item_id").distinct()
    whole = shingles.groupBy("item_id").agg(F.collect_list("shingle").alias("item_shingles"))
    checked = candidates.join(held, "held_id").join(whole, "item_id").select(
        "held_id", "item_id", F.size("item_shingles").cast("bigint").alias("n_item"),
        F.size(F.array_intersect("held", "item_shingles")).cast("bigint").alias("n_common"))
    verified = checked.where(F.col("n_common") * 5 >= F.col("n_item") * 4)
    return hits.select("doc_id", "held_id").join(verified, "held_id").select(
        "doc_id", "item_id", "n_item", "n_common", (F.col("n_common") / F.col("n_item")).alias("containment"))


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns."""
    return docs.join(find_leaks(docs, items).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
