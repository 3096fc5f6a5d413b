import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from catalogflow.functions.hashing import is_gold
from catalogflow.operators import filters as fl
from catalogflow.operators import splits as sp
from catalogflow.operators.registry import improvements
from conftest import rows

N = 3000


def make(spark, n=N, hot=True):
    """A third of the rows in one class, a class of one row, some without class."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        label = 7 if hot and i % 3 == 0 else (None if i % 50 == 1 else rng.randint(1, 6))
        data.append((i, 99 if i == 17 else label, i % 3 + 1))
    return data, spark.createDataFrame(data, "id long, label int, batch_id int")


def order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def by_class(data):
    groups = defaultdict(list)
    for i, label, _ in data:
        if label is not None:
            groups[label].append(i)
    return groups


def quotas(sizes, num, den):
    total = -(-sum(sizes.values()) * num // den)
    base = {c: n * num // den for c, n in sizes.items()}
    spare = total - sum(base.values())
    for c in sorted(sizes, key=lambda c: (-(sizes[c] * num % den), c))[:spare]:
        base[c] += 1
    return base


def test_gold_hash_matches_python(spark):
    df = spark.range(2000).select("id", is_gold(F.col("id")).alias("g"))
    for r in df.collect():
        digest = hashlib.md5(str(r["id"]).encode()).digest()
        assert r["g"] == (int.from_bytes(digest[:8], "big") % 10 == 0)


def test_val_flag_matches_brute_force(spark):
    data, df = make(spark)
    flagged = sp.stratified_flag(df, "label", "id", 0.1, 42, "val")
    picked = {r["id"] for r in flagged.where("val").collect()}
    groups = by_class(data)
    wanted = quotas({c: len(ids) for c, ids in groups.items()}, 1, 10)
    expected = {i for c, ids in groups.items() for i in order(ids, 42)[: wanted[c]]}
    assert picked == expected
    assert len(picked) == math.ceil(sum(len(g) for g in groups.values()) / 10)
    assert flagged.count() == N


@pytest.mark.parametrize("k", [2, 4, 5])
def test_folds_are_a_stratified_partition(spark, k):
    data, df = make(spark)
    folds = {r["id"]: r["fold"] for r in sp.stratified_kfold(df, "label", "id", k).collect()}
    for c, ids in by_class(data).items():
        for position, i in enumerate(order(ids, 42)):
            assert folds[i] == position * k // len(ids)
        if len(ids) >= k:
            sizes = Counter(folds[i] for i in ids)
            assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(folds[i] is None for i, label, _ in data if label is None)


def test_splits_ignore_row_order_and_partitioning(spark):
    data, df = make(spark)
    random.Random(1).shuffle(data)
    shuffled = spark.createDataFrame(data, df.schema).repartition(13)
    first, second = (sp.assign_batches(d, "label", "id").select("id", "batch_id") for d in (df.drop("batch_id"), shuffled.drop("batch_id")))
    assert rows(first.na.fill(0)) == rows(second.na.fill(0))


def test_batches_keep_class_shares(spark):
    data, df = make(spark)
    out = sp.assign_batches(df.drop("batch_id"), "label", "id").where("label is not null")
    total = out.count()
    sizes = Counter(r["batch_id"] for r in out.collect())
    assert set(sizes) == {1, 2, 3}
    assert sizes[1] == (total + 1) // 2
    for c, ids in by_class(data).items():
        share = out.where((F.col("label") == c) & (F.col("batch_id") == 1)).count()
        assert abs(share - len(ids) / 2) <= 1


def test_copies_of_one_key_stay_together(spark):
    # A third of all rows share one key; they all fall on the same side of every cut.
    ids = [5] * 500 + list(range(100, 1100))
    df = spark.createDataFrame([(i, 1) for i in ids], "id long, label int")
    folds = sp.stratified_kfold(df, "label", "id", 3).groupBy("id").agg(F.count_distinct("fold").alias("k"), F.count("*").alias("n"))
    assert folds.where("k > 1").count() == 0
    assert folds.agg(F.sum("n")).first()[0] == len(ids)


def test_versions_are_frozen_and_free_of_gold(spark):
    _, df = make(spark)
    gold = df.withColumn("is_gold", is_gold(F.col("id")))
    v1 = sp.val_selection(gold, 1, "label", "id")
    v2 = sp.val_selection(v1, 2, "label", "id")
    assert rows(v1.select("id", F.coalesce("is_val_selection_v1", F.lit(False)))) == rows(
        v2.select("id", F.coalesce("is_val_selection_v1", F.lit(False))))
    assert v2.where("is_gold and is_val_selection_v2").count() == 0
    assert v2.where("batch_id > 2 and is_val_selection_v2 is not null").count() == 0
    assert v2.where("is_val_selection_v2").count() == math.ceil(
        fl.val_superset(gold, 2).where("label is not null").count() / 10)


def test_sample_of_rare_class_may_be_empty(spark):
    data, df = make(spark)
    got = Counter(r["label"] for r in sp.stratified_sample(df, "label", "id", 0.3).collect())
    for c, ids in by_class(data).items():
        assert got.get(c, 0) == len(ids) * 3 // 10
    assert 99 not in got


def test_replay_keeps_newest_batch_whole(spark):
    _, df = make(spark)
    mix = sp.replay_mix(df, [1, 2, 3], "label", "id", 0.2)
    assert mix.where("batch_id = 3").count() == df.where("batch_id = 3").count()
    assert sp.replay_mix(df, [2], "label", "id", 0.2).count() == df.where("batch_id = 2").count()


def test_holdout_tables_are_disjoint(spark):
    _, df = make(spark, 400)
    t = sp.train_test_split(df, "label", "id", 0.15)
    assert t["y_train"].join(t["y_test"], "id").count() == 0
    assert t["x_train"].count() + t["x_test"].count() == df.where("label is not null").count()


def test_fractions_must_add_up(spark):
    with pytest.raises(ValueError):
        sp.assign_batches(spark.range(3).withColumn("label", F.lit(1)), "label", "id", (0.5, 0.4))


def test_shadow_batch_must_not_be_trained(spark):
    with pytest.raises(ValueError):
        fl.shadow_batch(spark.range(1), 1, [1, 2])


def test_improvements_across_blocks(spark):
    rng = random.Random(3)
    values = [rng.random() for _ in range(500)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "study string, trial long, value double")
    best, expected = None, []
    for i, v in enumerate(values):
        if best is None or v > best:
            expected.append(i)
            best = v
    got = improvements(df, block=7)
    assert sorted(r["trial"] for r in got.collect()) == expected
