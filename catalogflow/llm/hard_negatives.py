"""Hard-negative mining with anchor-clustered shared lists (MAXIMUS-style).

Rows of ``embeddings`` (vec_id, embedding, label) take part when the label, the vector and every
component are present and finite (a null vec_id also leaves a row out). Where vec_id is divisible
by 7 the label first becomes (label + 1) % 10. Each component x becomes floor(256 * x), x as
double, and a row's score against an anchor is the exact integer inner product (vectors of unequal
length count as padded with zeros). Higher scores come first, ties by the smaller vec_id.

Anchors are the rows whose vec_id is divisible by 100. An anchor's positives are its first
``POSITIVES`` other rows of the same label (all, if fewer). For each (anchor, positive) the
negatives are the first ``NEGATIVES`` rows of another label with
80 * positive_score <= 100 * negative_score <= 100 * positive_score (all, if fewer; none when the
positive's score is negative, since the band is then empty).

Method. Anchors are clustered by the signs of their vectors against ``HYPERPLANES`` fixed random
directions. Anchors are dealt into shares of about ``HELD_BYTES``, rows into stripes; every (share,
stripe) pair is one partition, which holds its anchors and streams its rows; these copies are
never broadcast. A task cuts each cluster of its anchors into groups of ``GROUP_ANCHORS`` and its rows
into blocks of ``BLOCK_ROWS``: the group's unit centroid and the widest angle of a member to it
give each row of a block an upper bound of its score with *any* member (angle difference, largest
or smallest member norm). The block is sorted by that bound, and the members walk the shared list
together, by matrix products, until the bound certifies that no later row can enter a member's
result; what a member has found so far goes on to the next block. Where no more than a few rows
could be spared, the list is walked unsorted and whole. Local results are combined with a
``row_number() <= k`` window that Spark limits before its shuffle. Two passes: positives first
(groups of one label against the rows of that label), then negatives against each positive's score.

Edge cases: empty table or no anchors give no rows; an anchor without same-label rows has no
positives and no output; ties of score are broken by vec_id; rows repeating a vec_id each take part as
candidates (an anchor's own id is never its positive); extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITIVES = 5
NEGATIVES = 5
ANCHOR_MODULUS = 100
RELABEL_MODULUS = 7
HYPERPLANES = 4  # clusters of anchors: at most 2 ** HYPERPLANES
GROUP_ANCHORS = 128  # anchors that share one walked list
BLOCK_ROWS = 8192  # rows of one block
CHUNK = 256  # an eighth of it is scored before a group's first test; later as many rows as it has seen, up to PIECE
HELD_BYTES = 192 << 20  # of anchors and their results that a task holds
STRIPE_BYTES = 128 << 20  # of rows that are dealt to a task
WAVES = 3  # tasks for each core, if the rows suffice
BUNDLE = 64  # groups whose bounds are computed at once
PIECE = 1024  # rows whose scores with a group are held at most
MAX_HITS = 1 << 17  # scores that wait for their place among an anchor's results

LEAST, MOST = -(2**63) + 1, 2**63 - 1

_OUT = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("other_id", T.LongType()),
    T.StructField("positive_id", T.LongType()), T.StructField("positive_score", T.LongType()),
    T.StructField("score", T.LongType()),
])


def prepare(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: (vec_id, label, vec array<long>)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % RELABEL_MODULUS == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(256.0)).cast("long")).alias("vec"),
        )
    )


class Shape(NamedTuple):
    """What the driver knows of the table: a few numbers, whatever its size."""

    rows: int
    anchors: int
    dim: int
    kind: str  # the narrowest integer type that holds every component
    width: int  # its bytes
    cores: int

    def grid(self, slots: int, k: int) -> tuple[int, int]:
        """Shares of anchors and stripes of rows."""
        held = self.dim * self.width + slots * (16 * k + 40) + 32
        shares = max(1, -(-self.anchors * held // HELD_BYTES))
        stripes = max(-(-WAVES * self.cores // shares), -(-self.rows * (self.dim * self.width + 64) // STRIPE_BYTES))
        return shares, max(1, min(stripes, -(-self.rows // BLOCK_ROWS)))


def _shape(rows: DataFrame) -> Shape:
    n, anchors, dim, high, low = rows.agg(
        F.count("*"), F.count(F.when(F.col("vec_id") % ANCHOR_MODULUS == 0, 1)), F.max(F.size("vec")),
        F.max(F.array_max("vec")), F.min(F.array_min("vec"))).first()
    peak = max(high or 0, -(low or 0) - 1)
    kind, width = next(x for x in (("short", 2), ("int", 4), ("long", 8)) if peak < 2 ** (8 * x[1] - 1))
    return Shape(n, anchors, max(1, dim or 0), kind, width, rows.sparkSession.sparkContext.defaultParallelism)


def _matrix(vecs: pa.ListArray, dim: int) -> np.ndarray:
    """A row for each vector, short ones padded with zeros."""
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    lengths = vecs.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


class _Groups:
    """A task's anchors in groups, with the best rows that each anchor has met.

    An anchor has ``slots`` results of ``k`` rows: one in the first pass, one for each positive in the
    second. A slot takes scores from ``floor`` to ``cap``; ``need`` is what a row must reach to enter it.
    """

    def __init__(self, anchors: pa.Table, dim: int, negatives: bool, size: int):
        self.negatives, self.k = negatives, NEGATIVES if negatives else POSITIVES
        cluster, label = (anchors[c].to_numpy() for c in ("cluster", "label"))
        order = np.lexsort((label, cluster))
        cluster, self.label, self.ids = cluster[order], label[order], anchors["vec_id"].to_numpy()[order]
        n = len(order)
        self.mat = np.concatenate([_matrix(x, dim) for x in anchors["vec"].chunks])[order]
        if negatives:
            self.pos_ids, cap = (self._padded(anchors[c].combine_chunks())[order] for c in ("pos_ids", "pos_scores"))
            self.floor = np.where(cap >= 0, cap - cap // 5, MOST)  # 80 * cap <= 100 * score; -1 pads the list
            self.cap = np.where(cap >= 0, cap, LEAST)
        else:
            self.floor, self.cap = np.full((n, 1), LEAST + 1), np.full((n, 1), MOST)
        self.slots = self.floor.shape[1]
        self.best_s, self.best_i = (np.full((n * self.slots, self.k), x) for x in (LEAST, MOST))
        self.need = self.floor.copy()
        self.least, self.most = self.need.min(axis=1), self.cap.max(axis=1)
        cut = np.diff(cluster) != 0
        if not negatives:
            cut |= np.diff(self.label) != 0
        edges = np.concatenate([[0], np.flatnonzero(cut) + 1, [n]])
        starts = [range(a, b, size) for a, b in zip(edges[:-1], edges[1:])]
        self.start = np.array([x for r in starts for x in r])
        self.end = np.array([min(x + size, r.stop) for r in starts for x in r])
        self.seen = np.zeros(len(self.start), dtype=np.int64)
        self.hits, self.n_hits = [], 0
        self.score, self.mask = np.empty(0), np.empty(0, dtype=bool)
        self.by_label = {}
        if not negatives:
            for g, x in enumerate(self.label[self.start]):
                self.by_label.setdefault(int(x), []).append(g)
        self._cones(dim)

    @staticmethod
    def _padded(lists: pa.ListArray) -> np.ndarray:
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        out = np.full((len(lengths), max(1, int(lengths.max()))), -1, dtype=np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return out

    def _cones(self, dim: int) -> None:
        """Each group's unit centroid, the cosine and sine of its widest angle, its largest and smallest norm."""
        g = len(self.start)
        self.centre, self.cos, self.sin = np.zeros((g, dim)), np.full((g, 1), -1.0), np.zeros((g, 1))
        self.big, self.small = np.zeros((g, 1)), np.zeros((g, 1))
        for i, (s, e) in enumerate(zip(self.start, self.end)):
            a = self.mat[s:e].astype(np.float64)
            norm = _norms(a)
            self.big[i], self.small[i] = norm.max(), norm.min()
            if self.small[i] == 0:
                continue
            centre = (a / norm[:, None]).sum(axis=0)
            if (length := np.linalg.norm(centre)) > 0:
                self.centre[i] = centre / length
                theta = math.acos(float(np.clip(a @ self.centre[i] / norm, -1.0, 1.0).min())) + 1e-9
                if theta < math.pi:
                    self.cos[i], self.sin[i] = math.cos(theta), math.sin(theta)
        self.peak = float(self.big.max())

    def bounds(self, groups: np.ndarray, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """An upper bound of anchor . row over all anchors of each group, for every row."""
        c = np.clip((self.centre[groups] @ x.T) / np.where(norm > 0, norm, 1.0), -1.0, 1.0)
        cos = np.where(c >= self.cos[groups], 1.0, c * self.cos[groups] + np.sqrt(1.0 - c * c) * self.sin[groups])
        big = self.big[groups]
        bound = norm * np.where(cos >= 0, big, self.small[groups]) * cos
        return bound + 1e-6 * norm * big + 1.0  # slack for rounding; scores are integers

    def block(self, ids: np.ndarray, labels: np.ndarray, mat: np.ndarray, chunk: int) -> None:
        """Every group meets a block of rows."""
        if not self.negatives:
            order = np.argsort(labels, kind="stable")
            ids, labels, mat = ids[order], labels[order], mat[order]
        x = mat.astype(np.float64)
        norm = _norms(x)
        # No partial sum of a score exceeds the product of the norms, so these types hold them exactly.
        limit = self.peak * float(norm.max()) * (1 + 1e-9)
        rows = mat.astype(np.float32 if limit < 2**24 else np.float64 if limit < 2**53 else np.int64)
        if self.negatives:
            parts = [(0, len(ids), np.arange(len(self.start)))]
        else:
            edges = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(ids)]])
            parts = [(a, b, np.array(g)) for a, b in zip(edges[:-1], edges[1:])
                     if (g := self.by_label.get(int(labels[a])))]
        for a, b, groups in parts:
            for at in range(0, len(groups), BUNDLE):
                some = groups[at:at + BUNDLE]
                for g, bound in zip(some, self.bounds(some, x[a:b], norm[a:b])):
                    self._walk(g, bound, ids[a:b], labels[a:b], rows[a:b], chunk)
        self._take()

    def _walk(self, g: int, bound: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray,
              chunk: int) -> None:
        """A group meets a list of rows, the highest bounds first if that may end the walk early."""
        first, n = self.start[g], len(ids)
        need = self.least[first:self.end[g]]
        members = self.mat[first:self.end[g]].astype(rows.dtype)
        order = None
        if 8 * np.count_nonzero(bound < need.max()) >= n:
            order = np.flatnonzero(bound >= need.min())
            order = order[np.argsort(-bound[order], kind="stable")]
            bound, n = bound[order], len(order)
        at = 0
        while at < n:
            active, end = slice(None), n
            if order is not None:
                active = np.flatnonzero(need <= bound[at])
                if not len(active):
                    break
                end = np.searchsorted(-bound, -need[active].min(), side="right")
            end = min(end, at + min(PIECE, max(1, chunk // 8, self.seen[g])))
            of = slice(at, end) if order is None else order[at:end]
            hit, score = self._reaching(members[active], rows[of], need[active])
            if 64 * len(hit) > len(score):
                most = self.most[first:self.end[g]][active]
                hit = hit[score[hit] <= most[hit // (end - at)]]
            if len(hit):
                a, r = np.divmod(hit, end - at)
                a = first + (a if order is None else active[a])
                self.hits.append((a, score[hit].astype(np.int64), ids[of][r], labels[of][r]))
                self.n_hits += len(hit)
                if len(hit) > 2 * len(need) or self.n_hits > MAX_HITS:
                    self._take()
            self.seen[g] += end - at
            at = end

    def _reaching(self, members: np.ndarray, rows: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the scores that reach their member's need, and all scores (member by member)."""
        shape, size = (len(members), len(rows)), len(members) * len(rows)
        if self.score.dtype != rows.dtype or len(self.score) < size:
            self.score, self.mask = np.empty(size, dtype=rows.dtype), np.empty(size + 8, dtype=bool)
        score = np.matmul(members, rows.T, out=self.score[:size].reshape(shape))
        np.greater_equal(score, need.astype(rows.dtype)[:, None], out=self.mask[:size].reshape(shape))
        self.mask[size:size + 8] = False
        words = np.flatnonzero(self.mask[:size + -size % 8].view(np.uint64))  # few have any
        hit = (words[:, None] * 8 + np.arange(8)).ravel()
        return hit[self.mask[hit]], self.score[:size]

    def _take(self) -> None:
        """Rows that were found to reach an anchor's need enter its slots."""
        if not self.hits:
            return
        a, s, ids, labels = (np.concatenate(x) for x in zip(*self.hits))
        self.hits, self.n_hits = [], 0
        ok = labels != self.label[a] if self.negatives else ids != self.ids[a]
        a, s, ids = a[ok], s[ok], ids[ok]
        found = []
        for j in range(self.slots):
            slot = a * self.slots + j
            need = self.need[a, j]
            ok = (s <= self.cap[a, j]) & ((s > need) | (s == need) & (ids < self.best_i[slot, -1]))
            found.append((slot[ok], s[ok], ids[ok]))
        slot, s, ids = (np.concatenate(x) for x in zip(*found))
        if not len(slot):
            return
        old = np.unique(slot)
        slot = np.concatenate([np.repeat(old, self.k), slot])
        s = np.concatenate([self.best_s[old].ravel(), s])
        ids = np.concatenate([self.best_i[old].ravel(), ids])
        order = np.lexsort((ids, -s, slot))
        slot, s, ids = slot[order], s[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        ok = place < self.k
        self.best_s[slot[ok], place[ok]], self.best_i[slot[ok], place[ok]] = s[ok], ids[ok]
        a, j = np.divmod(old, self.slots)
        self.need[a, j] = np.maximum(self.floor[a, j], self.best_s[old, -1])
        a = np.unique(a)
        self.least[a] = self.need[a].min(axis=1)

    def results(self, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.best_s), size):
            slot, place = np.nonzero(self.best_s[at:at + size] > LEAST)
            slot += at
            a, j = np.divmod(slot, self.slots)
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(self.ids[a]), pa.array(self.best_i[slot, place]),
                pa.array(self.pos_ids[a, j]) if self.negatives else none,
                pa.array(self.cap[a, j]) if self.negatives else none, pa.array(self.best_s[slot, place]),
            ], names=_OUT.names)


def _blocks(batches: Iterable[pa.RecordBatch], dim: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """ids, labels and vectors of ``size`` rows at a time."""
    held, count = [], 0
    for batch in batches:
        held.append((batch["vec_id"].to_numpy(), batch["label"].to_numpy(), _matrix(batch["vec"], dim)))
        count += batch.num_rows
        if count >= size:
            whole = [np.concatenate(x) for x in zip(*held)]
            for at in range(0, count - size + 1, size):
                yield tuple(x[at:at + size] for x in whole)
            held, count = [tuple(x[count - count % size:] for x in whole)], count % size
    if count:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _mine(batches: Iterator[pa.RecordBatch], dim: int, negatives: bool, group: int, block: int,
          chunk: int) -> Iterator[pa.RecordBatch]:
    """A partition's anchors come first, then its rows."""
    anchors, first = [], []
    for batch in batches:
        n = int(np.count_nonzero(batch["kind"].to_numpy() == 0))
        anchors.append(batch.slice(0, n))
        if n < batch.num_rows:
            first = [batch.slice(n)]
            break
    anchors = pa.Table.from_batches(anchors) if anchors else None
    if not anchors:
        for _ in batches:  # read to the end, as Spark expects
            pass
        return
    groups = _Groups(anchors, dim, negatives, group)
    del anchors
    for ids, labels, mat in _blocks((x for y in (first, batches) for x in y), dim, block):
        groups.block(ids, labels, mat, chunk)
    yield from groups.results()


def _local(rows: DataFrame, anchors: DataFrame, shape: Shape, negatives: bool) -> DataFrame:
    """The first rows of each anchor, or of each of its positives, among each stripe of the rows."""
    shares, stripes = shape.grid(POSITIVES if negatives else 1, NEGATIVES if negatives else POSITIVES)
    # Sign bits against fixed +-1 directions, direction h's sign at component i from a hash of (i, h).
    bits = [
        F.when(F.aggregate(F.transform("vec", lambda x, i: F.when(F.pmod(F.xxhash64(i, F.lit(h)), 2) == 0, x)
                                       .otherwise(-x)), F.lit(0).cast("long"), lambda acc, x: acc + x) >= 0, 1 << h)
        .otherwise(0)
        for h in range(HYPERPLANES)
    ]
    # Empty, not null: Arrow's writer goes over all nulls of a batch again at each null list.
    none = [F.array().cast("array<long>").alias(c) for c in ("pos_ids", "pos_scores")]
    pos = ["pos_ids", "pos_scores"] if negatives else none
    vec = F.col("vec").cast(f"array<{shape.kind}>").alias("vec")

    def dealt(n: int):  # by the row's place, not its id: ids may repeat
        return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")

    held = anchors.select(
        F.lit(0).cast("byte").alias("kind"), sum(bits[1:], bits[0]).alias("cluster"), "vec_id", "label", vec, *pos,
        dealt(shares).alias("share")).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    streamed = rows.select(
        F.lit(1).cast("byte").alias("kind"), F.lit(0).alias("cluster"), "vec_id", "label", vec, *none,
        dealt(stripes).alias("stripe")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    whole = (
        held.unionByName(streamed)
        .repartitionById(shares * stripes, (F.col("share") * stripes + F.col("stripe")).cast("int"))
        .drop("share", "stripe").sortWithinPartitions("kind")
    )
    dim, group, block, chunk = shape.dim, GROUP_ANCHORS, BLOCK_ROWS, CHUNK
    return whole.mapInArrow(lambda it: _mine(it, dim, negatives, group, block, chunk), _OUT)


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other_id"))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (see the module)."""
    rows = prepare(embeddings)
    anchors = prepare(embeddings.where(F.col("vec_id") % ANCHOR_MODULUS == 0))
    shape = _shape(rows)
    positives = _first(_local(rows, anchors, shape, False), ["anchor_id"], POSITIVES)
    positives = positives.where(F.col("score") >= 0).groupBy("anchor_id").agg(  # below 0 the band is empty
        F.collect_list(F.struct("other_id", "score")).alias("p"))
    with_pos = anchors.join(positives, F.col("vec_id") == F.col("anchor_id"), "inner").select(
        "vec_id", "label", "vec", F.col("p.other_id").alias("pos_ids"), F.col("p.score").alias("pos_scores"))
    return _first(_local(rows, with_pos, shape, True), ["anchor_id", "positive_id"], NEGATIVES).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
