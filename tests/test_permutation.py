"""Keyed permutations: bijections with an inverse, resumable without earlier rows."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from shardloom.operators import feed
from shardloom.operators.permutation import ROUNDS, at_place, place_of


def plain_place(x, n, key):
    a = max(1, math.isqrt(n - 1) + 1)
    b = -(-n // a)
    while True:
        u, v = divmod(x, b)
        for r in range(ROUNDS):
            h = int(hashlib.md5(f"{key}|{r}|{v}".encode()).hexdigest()[:15], 16)
            u, v = v, (u + h) % (b if r % 2 else a)
        x = u * b + v
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 16, 17, 97, 1000])
def test_bijection_and_inverse(spark, n):
    key = F.lit("42|1|shard_a")
    df = spark.range(n).select("id", place_of(F.col("id"), F.lit(n), key).alias("p"))
    rows = df.withColumn("back", at_place(F.col("p"), F.lit(n), key)).collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] and r["p"] == plain_place(r["id"], n, "42|1|shard_a") for r in rows)


def test_orders_differ_by_key_and_numbers_outside_are_null(spark):
    df = spark.range(-1, 51).select("id", *(place_of(F.col("id"), F.lit(50), F.lit(k)).alias(k) for k in "abc"))
    rows = df.collect()
    assert [[r[k] for k in "abc"] for r in rows if not 0 <= r["id"] < 50] == [[None] * 3] * 2
    orders = {k: tuple(r[k] for r in rows[1:51]) for k in "abc"}
    assert len(set(orders.values())) == 3
    assert all(sum(o[i] == i for i in range(50)) < 10 for o in orders.values())


def test_a_large_shard_needs_no_other_row(spark):
    n = 10**12 + 7
    rows = spark.createDataFrame([(0,), (12345,), (n - 1,)], "p long").select("p", at_place(F.col("p"), F.lit(n), F.lit("k")).alias("x"))
    assert all(plain_place(r["x"], n, "k") == r["p"] for r in rows.collect())


def manifest(spark):
    return spark.createDataFrame([("s1", 7), ("s2", 0), ("s3", 23), ("s4", 1), ("s5", 12)], "shard string, n_chunks long")


def test_order_covers_every_chunk_once_and_resumes(spark):
    man = manifest(spark)
    whole = feed.keyed_order(man, 3, 4, num_workers=2, seed=1).collect()
    for e in range(3):
        got = sorted((r["shard"], r["chunk"]) for r in whole if r["epoch"] == e)
        assert got == sorted((r["shard"], c) for r in man.collect() for c in range(r["n_chunks"]))
    seats = {(r["epoch"], r["worker"], r["batch_id"], r["pos_in_batch"]) for r in whole}
    assert len(seats) == len(whole)
    for batch in (0, 2, 5, 50):
        some = feed.keyed_order(man, 2, 4, num_workers=2, seed=1, first_epoch=1, first_batch=batch).collect()
        assert sorted(some) == sorted(r for r in whole if r["epoch"] == 2 or (r["epoch"] == 1 and r["batch_id"] >= batch))
    shards = {(r["epoch"], r["worker"], r["batch_id"], r["pos_in_batch"]): r["shard"] for r in feed.epoch_order(man, 3, 4, num_workers=2, seed=1).collect()}
    assert all(shards[r[:4]] == r["shard"] for r in whole)


def test_chunk_rows_are_not_shuffled(spark):
    plan = feed.keyed_order(manifest(spark), 2, 4, num_workers=2)._jdf.queryExecution().executedPlan().toString()
    unfolded = plan.index("Generate explode(sequence")
    assert "Exchange" not in plan[:unfolded] and "Sort" not in plan[:unfolded] and "Window" not in plan[:unfolded]


def test_wrong_parameters(spark):
    with pytest.raises(ValueError):
        feed.keyed_order(manifest(spark), 1, 4, num_workers=2, first_batch=-1)
    assert feed.keyed_order(manifest(spark).limit(0), 1, 4, num_workers=2).count() == 0
