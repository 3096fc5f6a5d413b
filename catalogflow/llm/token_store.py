"""Token ids of texts in a binary format of shuffled planes, written and read by Spark.

A store is a Parquet table with a row per chunk. Chunks hold ``block_ids`` ids (the last of a part fewer) as one
payload: the ids of the block as unsigned 32-bit integers, transposed into planes of bits or bytes and each plane
compressed with zstandard. The other columns are the chunk index: part, number in the part, first id, ids, the
documents that begin in the chunk with their offset, and the document of an earlier chunk that goes on in this one
(tail). A chunk is thus read without another. Parts are ranges of the order column, so part by part and chunk by chunk
the ids are in ascending order.

Payload: ``BPL1``, one byte for the planes (0 bytes, 1 bits), the number of ids (u32), the number of planes (u8), the
length of each compressed plane (u32 each), then the planes. All integers are little-endian.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.session import fresh_path

BLOCK_IDS = 1 << 16
LEVEL = 3
CACHED_WORDS = 600_000  # bound of the words whose ids a worker remembers
END_ID = 2
_HEAD = struct.Struct("<4sBIB")
CHUNK_SCHEMA = (
    "part int, chunk int, first_local long, n_ids long, payload binary,"
    " documents array<struct<doc_id:bigint,at:bigint,n_tokens:bigint>>,"
    " tail struct<doc_id:bigint,at:bigint,n_tokens:bigint>"
)


def pack(ids: np.ndarray, planes: str = "byte", level: int = LEVEL) -> bytes:
    """A block of ids as a payload."""
    rows = ids.astype("<u4").view(np.uint8).reshape(len(ids), 4)
    if planes == "byte":
        parts = [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(4)]
    else:
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        parts = [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]
    press = zstandard.ZstdCompressor(level=level)
    packed = [press.compress(p) for p in parts]
    head = _HEAD.pack(b"BPL1", planes != "byte", len(ids), len(packed))
    return head + struct.pack(f"<{len(packed)}I", *map(len, packed)) + b"".join(packed)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    magic, bitwise, n, count = _HEAD.unpack_from(payload)
    if magic != b"BPL1":
        raise ValueError("not a block of token ids")
    sizes = struct.unpack_from(f"<{count}I", payload, _HEAD.size)
    at, press, rows = _HEAD.size + 4 * count, zstandard.ZstdDecompressor(), []
    for size in sizes:
        rows.append(np.frombuffer(press.decompress(payload[at:at + size]), dtype=np.uint8))
        at += size
    if bitwise:
        bits = np.stack([np.unpackbits(r, count=n, bitorder="little") for r in rows], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(n, 4).copy().view("<u4").ravel()
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


# A word of small letters of the first 256 signs, then other signs: the tokenizer cuts between the two.
_LETTERS_THEN_SIGNS = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]+)([^\w\s\u0100-\U0010ffff]*)")


class WordEncoder(dict):
    """Ids of blank-separated words as little-endian bytes.

    The tokenizer drops white space and never joins signs across it, so a text's ids are those of its words in
    turn; each distinct word is encoded once while it is remembered. It also counts capitals as small letters: texts
    of the first 256 signs, where that is the same sign by sign, are taken in small letters from the start.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(0x80, 0x100)}

    def __missing__(self, word: str) -> bytes:
        parts = _LETTERS_THEN_SIGNS.fullmatch(word)
        if parts and parts[2]:
            return self[parts[1]] + self[parts[2]]
        if parts:
            # One piece without anything to normalise: straight to the tokenizer's merges.
            ids = [t.id for t in self.merges.tokenize(word.translate(self.letters))]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:  # frequent words are back at once
                self.clear()
                self[""] = b""
            self[word] = packed
        return packed

    def text(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _chunk_writer(path: str, end_id: int, block_ids: int, planes: str, level: int) -> Callable:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = struct.pack("<I", end_id)
        pending, held, chunk, documents, total, last = [], 0, 0, [], 0, None

        def cut(data: bytes) -> pa.RecordBatch:
            nonlocal chunk, documents, last
            first, n = chunk * block_ids, len(data) // 4
            here = [d for d in documents if d["at"] < first + n]
            documents = documents[len(here):]
            tail = last if last and last["at"] + last["n_tokens"] > first else None
            row = {"part": part, "chunk": chunk, "first_local": first, "n_ids": n,
                   "payload": pack(np.frombuffer(data, dtype="<u4"), planes, level), "documents": here, "tail": tail}
            last = here[-1] if here else last
            chunk += 1
            return pa.RecordBatch.from_pylist([row], schema=_CHUNKS)

        for batch in batches:
            encoder = word_encoder(path)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encoder.text(text.as_py() or "") + end
                documents.append({"doc_id": key, "at": total, "n_tokens": len(data) // 4})
                total += len(data) // 4
                pending.append(data)
                held += len(data)
                if held >= 4 * block_ids:
                    data = b"".join(pending)
                    while len(data) >= 4 * block_ids:
                        yield cut(data[:4 * block_ids])
                        data = data[4 * block_ids:]
                    pending, held = [data], len(data)
        if held:
            yield cut(b"".join(pending))

    return write


_DOCUMENT = pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_CHUNKS = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("first_local", pa.int64()), ("n_ids", pa.int64()),
    ("payload", pa.binary()), ("documents", pa.list_(_DOCUMENT)), ("tail", _DOCUMENT),
])


def write_store(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    order: Column | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    planes: str = "byte",
    level: int = LEVEL,
    parts: int | None = None,
) -> None:
    """Encode ``docs(doc_id, text)`` in ascending ``order`` (``doc_id`` if not given) and write the store to ``path``.

    Rows are dealt out by ranges of the order, the text only once, and sorted in each range; ties keep any order.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id") if order is None else order
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), order.alias("__order"))
    dealt = rows.repartitionByRange(parts, "__order").sortWithinPartitions("__order").select("doc_id", "text")
    dealt.mapInArrow(_chunk_writer(tokenizer, end_id, block_ids, planes, level), CHUNK_SCHEMA).write.parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The chunks with the global number of their first id."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row per part, not per document or chunk: broadcast, so that payloads are never shuffled.
    offsets = sizes.select("part", F.expr(
        "sum(ids) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ids").alias("part_first"))
    return chunks.join(F.broadcast(offsets), "part").withColumn("first_id", F.col("part_first") + F.col("first_local"))


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document and chunk: the checksum where the chunk holds the whole document, else the ids themselves."""
    for batch in batches:
        for row in batch.to_pylist():
            raw, first, out = unpack(row["payload"]).tobytes(), row["first_local"], []
            if row["tail"]:
                # Ids before the first document that begins here belong to one that began in an earlier chunk.
                end = min(row["documents"][0]["at"] if row["documents"] else first + row["n_ids"], first + row["n_ids"])
                out.append((row["tail"]["doc_id"], row["tail"]["at"] + row["part_first"], row["tail"]["n_tokens"],
                            row["chunk"], None, raw[:4 * (end - first)]))
            for d in row["documents"]:
                a = d["at"] - first
                piece = raw[4 * a:4 * (a + d["n_tokens"])]
                whole = len(piece) == 4 * d["n_tokens"]
                out.append((d["doc_id"], d["at"] + row["part_first"], d["n_tokens"], row["chunk"],
                            zlib.crc32(piece) if whole else None, None if whole else piece))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), _DIGEST_TYPES, strict=True)],
                    names=["doc_id", "start", "n_tokens", "chunk", "crc", "piece"])


_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: number of its first id, number of ids, checksum of the ids."""
    columns = ["chunk", "first_local", "n_ids", "payload", "documents", "part_first", "tail"]
    found = open_store(spark, path).select(*columns).mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, chunk int, crc long, piece binary")
    # Documents over several chunks: their pieces, in order, are one document's ids at most.
    pieces = found.groupBy("doc_id", "start", "n_tokens").agg(
        F.max("crc").alias("crc"), F.array_sort(F.collect_list(
            F.when(F.col("piece").isNotNull(), F.struct("chunk", "piece")))).alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    return pieces.select(
        "doc_id", "start", "n_tokens",
        F.when(F.size("pieces") > 0, F.crc32(joined)).otherwise(F.col("crc")).alias("ids_crc32"))


def store_and_digest(docs: DataFrame, tokenizer: str, order: Column | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` to a store on shared storage and report per document what the store holds.

    Null and empty texts give the end id alone. Rows given twice are encoded twice, one behind the other. An empty
    table gives an empty store and no rows. Needs ``doc_id`` and ``text``; other columns are not read.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "token-store")
    write_store(docs, tokenizer, path, order, **options)
    return read_digests(spark, path)
