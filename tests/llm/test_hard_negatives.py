"""Hard-negative mining (op12) against brute force, with nulls, non-finite components, ties, repeats and empties."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from catalogflow.llm import hard_negatives

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("vec_id_extra", T.StringType()),
])


def brute(rows):
    clean = []
    for vid, emb, lab, _ in rows:
        if vid is None or lab is None or emb is None or any(x is None or not math.isfinite(x) for x in emb):
            continue
        if vid % 7 == 0:
            lab = (lab + 1) % 10
        clean.append((vid, lab, [math.floor(256 * float(x)) for x in emb]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for aid, alab, avec in clean:
        if aid % 100:
            continue
        key = lambda r: (-score(avec, r[2]), r[0])
        for pid, _, pvec in sorted([r for r in clean if r[1] == alab and r[0] != aid], key=key)[:5]:
            ps = score(avec, pvec)
            band = [r for r in clean if r[1] != alab and 80 * ps <= 100 * score(avec, r[2]) <= 100 * ps]
            for k, (nid, _, nvec) in enumerate(sorted(band, key=key)[:5], 1):
                out.append((aid, pid, k, nid, ps, score(avec, nvec)))
    return sorted(out)


def run(spark, rows):
    got = hard_negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(tuple(r) for r in got)


def fixture(n, dim, seed, labels=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        vec = [round(rnd.gauss(0, 0.3), 3) for _ in range(dim)]
        rows.append((i, vec, rnd.randrange(labels), "x"))
    return rows


@pytest.mark.parametrize("block,group", [(8192, 128), (37, 2)])
def test_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", group)
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    rows = fixture(700, 8, 1)
    # nulls, non-finite components, zero vectors, ties and a repeated id
    rows += [(800, None, 1, None), (900, [1.0, float("nan")] + [0.0] * 6, 1, "y"), (1000, [0.0] * 8, 2, None),
             (1100, [0.5] * 8, None, "z"), (1200, [0.5] * 8, 1, "z"), (1201, [0.5] * 8, 1, "z"),
             (1202, [0.5] * 8, 2, "z"), (1203, [0.5] * 8, 2, "z"), (1300, [0.25] * 8, 1, None),
             (1203, [0.5] * 8, 0, "dup"), (None, [0.1] * 8, 1, None), (1400, [0.1, None] + [0.0] * 6, 1, None)]
    expected = brute(rows)
    assert expected, "the fixture must produce negatives"
    assert run(spark, rows) == expected


def test_empty_and_no_anchor(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.1, 0.2], 1, None), (2, [0.2, 0.1], 2, None)]) == []
    # an anchor alone in its label: no positives, no rows
    assert run(spark, [(100, [0.1, 0.2], 1, None), (2, [0.2, 0.1], 2, None)]) == []


def broadcast_rows(plan):
    """Rows that went through the driver to be broadcast, in a plan that has run."""
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            total += node.metrics().apply("numOutputRows").value()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_anchors_are_not_broadcast_for_every_block(spark, monkeypatch):
    """A copy of the anchors for each of many blocks of rows must not go through the driver."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 4)
    rows = fixture(1500, 8, 2)
    df = hard_negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in df.collect()) == brute(rows)
    assert broadcast_rows(df._jdf.queryExecution().executedPlan()) <= len([r for r in rows if r[0] % 100 == 0])


@pytest.mark.parametrize("scale", [1, 40, 500_000])  # scores in floats, doubles and integers
def test_shares_stripes_and_early_ends(spark, monkeypatch, scale):
    """Several shares of anchors and stripes of rows; narrow clusters of very different lengths, whose walks end early."""
    for name, value in {"BLOCK_ROWS": 64, "GROUP_ANCHORS": 4, "CHUNK": 8, "PIECE": 32, "MAX_HITS": 50, "HELD_BYTES": 4096,
                        "BUNDLE": 2}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(1200):
        length = scale * rnd.choice([0.1, 0.5, 1.0])
        vec = [length * (x + rnd.gauss(0, 0.05)) for x in centres[rnd.randrange(5)]]
        rows.append((i * 5, vec[: rnd.choice([6, 6, 6, 5, 0])], rnd.randrange(4) if i % 3 else i, "x"))
    expected = brute([(i, [np.float32(x) for x in v], lab, e) for i, v, lab, e in rows])
    assert expected
    assert run(spark, rows) == expected
