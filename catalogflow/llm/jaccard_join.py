"""Self-join of documents on the Jaccard similarity of their word shingles, heavy and light sets apart.

Two sets A, B link when |A & B| / |A | B| >= 0.9, which is the same as |A xor B| <= (|A| + |B|) // 19.

* Light sets (up to a boundary) enumerate their subsets of each size that a link of theirs can require; sets that
  link share such a subset.
* Heavy sets are found through inverted lists. Single shingles would make lists as long as the shingle is common, so
  a list's key is a block of the set: in a class of sizes linked sets differ in at most D shingles, hence of D + 1
  blocks, dealt by hash, at least one is the same in both.
* The boundary is the size at which enumerating all light sets costs more keys than scanning and verifying would.

A set is thus found by keys that any partner must share; no list is cut. Equal sets are one node from the start.
Lists are scanned in two steps: each member against its list's pivot, and, once the links found have been joined to
components, members outside their list's main component against the whole list. A bound on |A xor B| from 512 parity
bits drops most false pairs before sets are fetched; every remaining pair is verified on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import in_bitmap, key_bitmap
from catalogflow.llm.components import components
from catalogflow.llm.shingles import Words, mix, sliced, text_buffer
from catalogflow.session import materialize

SHINGLE = 3
NUMER, DENOM = 9, 19  # a link needs |A & B| >= (|A| + |B|) * 9 / 19, similarity 90 / 100
SMALLEST = 9  # below this size only equal sets link
MAX_LIGHT = 40  # sizes weighed as boundary
VERIFY_COST = 2  # keys that fetching one shingle of a set to verify a pair is worth
BITMAP_BITS = 1 << 25
PARITY = [f"parity{i}" for i in range(8)]
_U = np.uint64


def most_apart(total: int) -> int:
    """Largest |A xor B| of linked sets with |A| + |B| = ``total``."""
    return total // DENOM


@lru_cache(maxsize=1)
def _classes() -> list[int]:
    """Lower bounds of the size classes: linked sets lie in one class or in neighbours."""
    bounds = [SMALLEST]
    while bounds[-1] < 1 << 31:
        bounds.append(bounds[-1] * 10 // 9 + 1)
    return bounds


def size_class(n: int) -> int:
    return int(np.searchsorted(_classes(), n, side="right")) - 1


def blocks_of(cls: int) -> int:
    """Blocks of a class whose pairs come from it and the class below."""
    return most_apart(2 * (_classes()[cls + 1] - 1)) + 1


def removals(n: int) -> set[int]:
    """How many shingles a set of ``n`` may lack of what it shares with a partner, over all partner sizes."""
    out = set()
    for m in range(-(-n * 9 // 10), n * 10 // 9 + 1):
        common = -(-NUMER * (n + m) // DENOM)
        if common <= min(n, m):
            out.add(n - common)
    return out


def light_keys(n: int) -> int:
    return sum(comb(n, d) for d in removals(n))


def boundary(histogram: dict[int, int]) -> int:
    """Largest light size: enumeration has cost less than scanning up to there."""
    best, spent, saved, least = SMALLEST - 1, 0, 0, 0
    for n in range(SMALLEST, MAX_LIGHT + 1):
        cls = size_class(n)
        spent += histogram.get(n, 0) * light_keys(n)
        saved += histogram.get(n, 0) * (blocks_of(cls) + blocks_of(cls + 1) + VERIFY_COST * n)
        if spent - saved < least:
            best, least = n, spent - saved
    return best


def keys_of(s: np.ndarray, light: int) -> np.ndarray:
    """All keys of a sorted set of shingle hashes."""
    n, out = len(s), []
    if n < SMALLEST:
        return np.zeros(0, dtype=np.uint64)
    mixed = mix(s)
    if n <= light:
        total = mixed.sum(dtype=np.uint64)
        for d in sorted(removals(n)):
            if d == 0:
                gone = np.zeros(1, dtype=np.uint64)
            else:
                gone = mixed[np.array(list(combinations(range(n), d)))].sum(axis=1, dtype=np.uint64)
            out.append(mix(total - gone + _U(((n - d) << 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
    if n * 10 > light * 9:
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mixed, out=sums[1:])
        cls = size_class(n)
        for c in (cls, cls + 1):
            k = blocks_of(c)
            # Sorted hashes fall into the blocks in order.
            cuts = np.searchsorted((s >> _U(32)) * _U(k) >> _U(32), np.arange(k + 1))
            salt = (np.arange(k, dtype=np.uint64) << _U(20) | _U(c << 1 | 1)) * _U(0xD6E8FEB86659FD93)
            out.append(mix(sums[cuts[1:]] - sums[cuts[:-1]] + mix(salt)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text of the batch's second column."""
    words = Words(*text_buffer(batch.column(1)))
    hashes, inside = words.shingles(SHINGLE)
    counts = np.diff(words.first)
    for row in range(len(counts)):
        n, first = int(counts[row]), int(words.first[row])
        if n >= SHINGLE:
            yield row, np.unique(hashes[first:first + n - SHINGLE + 1])
        elif n:
            yield row, words.whole(row)
        else:
            yield row, np.zeros(0, dtype=np.uint64)
    del inside


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        sizes, prints, parity = [], [], []
        for _, s in _sets(batch):
            mixed = mix(s + _U(1))
            sizes.append(len(s))
            prints.append((mixed.sum(dtype=np.uint64), mix(mixed).sum(dtype=np.uint64)))
            bits = np.bincount((s & _U(511)).astype(np.int64), minlength=512) & 1
            parity.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
        prints = np.array(prints, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        parity = np.array(parity, dtype=np.int64).reshape(-1, 8)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
             *[pa.array(parity[:, i]) for i in range(8)]],
            names=["doc_id", "n_shingles", "print_a", "print_b", *PARITY])


def _postings(light: int, bitmap: np.ndarray | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, keys = batch.column(0).to_numpy(zero_copy_only=False), []
            counts = np.zeros(len(batch), dtype=np.int64)
            for row, s in _sets(batch):
                k = keys_of(s, light)
                if bitmap is not None and len(k):
                    k = k[in_bitmap(bitmap, k)]
                counts[row] = len(k)
                keys.append(k)
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
            key = pa.array(flat.view(np.int64))
            if bitmap is None:
                yield pa.RecordBatch.from_arrays([key], names=["key"])
            else:
                yield pa.RecordBatch.from_arrays([key, pa.array(np.repeat(ids, counts))], names=["key", "doc_id"])

    return run


def _wanted_sets(bitmap: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            mask = in_bitmap(bitmap, ids.astype(np.int64).view(np.uint64))
            part = batch.filter(pa.array(mask))
            if len(part):
                sets = [s.tobytes() for _, s in _sets(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, type=pa.binary())], names=["node", "members"])

    return run


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            a = np.frombuffer(a.as_buffer(), dtype=np.uint64)
            b = np.frombuffer(b.as_buffer(), dtype=np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(common * DENOM >= (len(a) + len(b)) * NUMER)
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep))


def _near(a: str, b: str) -> Column:
    """What the sizes and parities of two sets allow: no linked pair fails it."""
    apart = F.expr(" + ".join(f"bit_count({a}.{p} ^ {b}.{p})" for p in PARITY))
    return apart * DENOM <= F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")


def _verify(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets link; sets are made again for the nodes in question only."""
    pairs = materialize(pairs, "jaccard-pairs")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    bitmap = key_bitmap(ends, "node", BITMAP_BITS)
    sets = materialize(
        rows.mapInArrow(_wanted_sets(bitmap), "node long, members binary").join(ends, "node", "left_semi"), "jaccard-sets")
    a = sets.select(F.col("node").alias("u"), F.col("members").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("members").alias("b"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")
    return both.mapInArrow(_verified, "u long, v long")


def shingle_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: size of its shingle set and smallest id it reaches by links.

    A text of fewer than three words has them all as its one shingle; null, empty and blank texts have none, link
    with nothing and are their own component. Rows of one id are one document: what any of them links with, all
    do. Rows without an id are compared by equality only and take the smallest id of their equals, if any. Needs
    ``doc_id`` and ``text``; other columns are not read. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    summary = materialize(rows.mapInArrow(
        _summaries, "doc_id long, n_shingles long, print_a long, print_b long, " + ", ".join(f"{p} long" for p in PARITY)),
        "jaccard-summaries")
    full = summary.where(F.col("n_shingles") > 0)
    # Equal sets are one node, named by its smallest id.
    same = ["n_shingles", "print_a", "print_b"]
    equal = full.groupBy(*same).agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("times"), *[F.first(p).alias(p) for p in PARITY])
    nodes = materialize(equal.where(F.col("node").isNotNull()), "jaccard-nodes")
    copies = materialize(
        full.where(F.col("doc_id").isNotNull()).join(nodes.where(F.col("times") > 1).select(*same, "node"), same)
        .where(F.col("doc_id") != F.col("node")).select("doc_id", "node").distinct(), "jaccard-copies")
    sizes = {r[0]: r[1] for r in nodes.where(F.col("n_shingles") <= MAX_LIGHT).groupBy("n_shingles").count().collect()}
    light = boundary(sizes)

    with_id = rows.where(F.col("doc_id").isNotNull())
    shared = with_id.mapInArrow(_postings(light, None), "key long").groupBy("key").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    bitmap = key_bitmap(materialize(shared, "jaccard-shared-keys"), "key", BITMAP_BITS)
    posted = with_id.mapInArrow(_postings(light, bitmap), "key long, doc_id long")
    lists = posted.join(copies, "doc_id", "left").select("key", F.coalesce("node", "doc_id").alias("node")).distinct()
    lists = materialize(lists, "jaccard-lists")

    known = nodes.select("node", "n_shingles", *PARITY)
    pivots = lists.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    stars = lists.join(pivots, "key").where(F.col("node") != F.col("pivot")).select(
        F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    stars = stars.join(known.alias("a"), F.col("u") == F.col("a.node")).join(
        known.alias("b"), F.col("v") == F.col("b.node")).where(_near("a", "b")).select("u", "v")
    links = materialize(_verify(stars, with_id), "jaccard-links")

    # Lists whose members are not all joined yet: the rest against everybody in another component.
    found = materialize(components(links), "jaccard-first")
    placed = lists.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    per_list = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    open_lists = materialize(placed.join(per_list.where(F.col("parts") > 1), "key").join(known, "node"), "jaccard-open")
    rest = open_lists.where(F.col("component") != F.col("main"))
    left, right = rest.alias("a"), open_lists.alias("b")
    across = left.join(right, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
                       & _near("a", "b")).select(
        F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()
    across = across.join(stars.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), ["u", "v"], "left_anti")
    more = _verify(across, with_id)
    joined = links.unionByName(more).unionByName(copies.select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    final = components(joined)
    equal_ids = equal.select(*same, F.col("node").alias("equal_to")).where(F.col("times") > 1)
    own = summary.select("doc_id", *same).join(final, F.col("doc_id") == F.col("node"), "left").drop("node")
    nameless = own.where(F.col("doc_id").isNull()).drop("component").join(equal_ids, same, "left").join(
        final, F.col("equal_to") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "equal_to").alias("component_id"))
    named = own.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return named.unionByName(nameless)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with their columns; rows without id stay."""
    gone = shingle_components(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
