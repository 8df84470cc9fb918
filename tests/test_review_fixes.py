"""Silent losses found in review: null labels, losses that are not finite,
ranks without rows, machine-local folders, date bounds that miss the scan."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shardloom.functions.templates import render
from shardloom.operators import trainlog
from shardloom.operators.limits import sample_limit
from shardloom.operators.packing import cut_windows, flatten_tokens, pack_blocks
from shardloom.operators.windows import assign_windows
from shardloom.plans.feed import FeedSpec, feed_batches
from shardloom.session import ensure_checkpoint_dir
from shardloom.sources.npy import read_npy_shards, write_npy_shards


def test_null_field_keeps_the_document(spark):
    df = spark.createDataFrame([(1, None), (2, "A01")], "doc_id long, label string")
    got = {r["doc_id"]: r["p"] for r in df.select("doc_id", render("Class {c}.", {"c": "label"}).alias("p")).collect()}
    assert got == {1: "Class None.", 2: "Class A01."}


def _log(spark, rows):
    t = dt.datetime(2024, 1, 1)
    data = [(r, 0, s, float(x), t + dt.timedelta(seconds=s)) for r, s, x in rows]
    return spark.createDataFrame(data, "rank long, epoch long, step long, loss double, ts timestamp")


def test_loss_that_is_not_finite_spoils_the_mean(spark):
    for bad in (float("nan"), float("inf")):
        log = _log(spark, [(0, 0, 1.0), (0, 1, bad), (0, 2, 1.0), (0, 3, 3.0)])
        got = trainlog.loss_windows(log, 1, 2, 10).orderBy("log_window").collect()
        assert got[0]["mean_loss"] != got[0]["mean_loss"] and got[0]["perplexity"] != got[0]["perplexity"]
        assert got[1]["mean_loss"] == 2.0


def test_window_without_a_rank_is_not_full(spark):
    log = _log(spark, [(0, 0, 1.0), (0, 1, 1.0), (0, 2, 1.0), (0, 3, 1.0), (1, 0, 1.0), (1, 1, 1.0)])
    assert [r["log_window"] for r in trainlog.loss_windows(log, 1, 2, 10).collect()] == [0]


def test_checkpoint_folder_must_be_shared_off_local():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_both_date_bounds_reach_the_scan(spark, tmp_path):
    days = [dt.date(2015, 3, 1) + dt.timedelta(days=i) for i in range(0, 900, 7)]
    spark.createDataFrame([(d,) for d in days], "d date").write.parquet(str(tmp_path / "t"))
    df = assign_windows(spark.read.parquet(str(tmp_path / "t")), "d", "2015-03-01", "2016-02-29", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d," in plan and "LessThan(d," in plan
    assert df.agg(F.max("window_end")).first()[0] == dt.date(2016, 3, 1)
    assert df.count() == sum(d < dt.date(2016, 3, 1) for d in days)


TOK = "shard string, doc_id long, input_ids array<int>, labels array<int>, length int"


def _tok(spark, rows):
    return spark.createDataFrame([(s, d, ids, ids, len(ids)) for s, d, ids in rows], TOK)


def test_null_keys_keep_their_tokens(spark):
    tok = _tok(spark, [("a", None, [1, 2]), ("a", 4, [3, 4]), (None, 1, [5, 6]), (None, 2, [7, 8])])
    got = {r["shard"]: list(r["input_ids"]) for r in pack_blocks(tok, ["shard"], ["doc_id"], 4).collect()}
    assert got == {"a": [1, 2, 3, 4], None: [5, 6, 7, 8]}
    assert flatten_tokens(tok, ["shard"], ["doc_id"]).count() == 8


def test_rows_that_tie_fail(spark):
    tok = _tok(spark, [("a", 1, [1, 2]), ("a", 1, [3, 4]), ("a", 2, [5, 6])])
    with pytest.raises(Exception, match="must be total"):
        pack_blocks(tok, ["shard"], ["doc_id"], 2).collect()


def test_wrong_block_size_fails(spark):
    stored = pack_blocks(_tok(spark, [("a", i, [i, i, i]) for i in range(9)]), ["shard"], ["doc_id"], 4, keep_tail=True)
    assert cut_windows(stored, 6, block_size=4).count() == 4
    for wrong in (2, 3, 8):
        with pytest.raises(ValueError, match="tokens each"):
            cut_windows(stored, 6, block_size=wrong)


def test_sample_limit_beyond_the_group_limit(spark):
    df = spark.range(14_000).selectExpr("id", "if(id % 7 < 5, 'hot', 'g') as g", "cast(id as string) as v")
    got = sorted((r["g"], r["id"]) for r in sample_limit(df, 5000, ["id"], ["g"]).collect())
    by = {g: [i for i in range(14_000) if (i % 7 < 5) == (g == "hot")][:5000] for g in ("hot", "g")}
    assert got == sorted((g, i) for g, ids in by.items() for i in ids)


def test_second_export_replaces_the_first(spark, tmp_path):
    blocks = pack_blocks(_tok(spark, [("shard_a", i, list(range(8))) for i in range(40)]), ["shard"], ["doc_id"], 8)
    path, before = str(tmp_path / "npy"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("4", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            write_npy_shards(blocks, path)
            assert read_npy_shards(spark, path, 8).count() == 40
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        write_npy_shards(blocks, path, mode="append")  # parts of two exports in one folder
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(Exception, match="overlap or leave a gap"):
        read_npy_shards(spark, path, 8).count()


def test_feed_reads_the_arrays_once(spark, tmp_path):
    blocks = pack_blocks(_tok(spark, [(f"s{i % 3}", i, list(range(9))) for i in range(30)]), ["shard"], ["doc_id"], 4, keep_tail=True)
    blocks.withColumn("n_tokens", F.size("input_ids")).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    out = feed_batches(stored, FeedSpec(chunk_size=6, batch_size=2, num_workers=2, shuffle_chunks=True, block_size=4))
    scans = re.findall(r"ReadSchema: (.*)", out._jdf.queryExecution().executedPlan().toString())
    assert sum("input_ids" in s for s in scans) == 1
    rows = out.collect()
    assert sorted(r["delivery"] for r in rows) == list(range(len(rows))) and sum(r["n_samples"] for r in rows) == 45
