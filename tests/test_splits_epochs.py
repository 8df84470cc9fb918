"""Validation shards, write report, epoch orders, user tokenizers, pushed date bounds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from checks import params as P
from shardloom.functions.tokenizer import tokenize
from shardloom.operators import feed
from shardloom.plans.build import build_shards, build_splits, write_report
from shardloom.plans.feed import FeedSpec, epoch_orders
from shardloom.sources.tables import corpus_view
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_both_date_bounds_are_pushed(spark):
    pushed = next(line for line in plan_of(E.q_scan_window(spark, SF_SMALL)).split("\n") if "PushedFilters" in line)
    assert "GreaterThanOrEqual(o_orderdate," in pushed and "LessThan(o_orderdate," in pushed


def test_splits_do_not_share_documents_and_report_their_rows(spark, tmp_path):
    corpus = corpus_view(spark, SF_SMALL)
    stored = build_splits(corpus, E.SPEC, {"train": P.TRAIN, "val": P.VAL, "none": ("1990-01-01", "1990-05-01")}, str(tmp_path))
    val = write_report(stored["val"]).first()
    n = stored["val"].agg(F.sum(F.size("input_ids")), F.count("*")).first()
    assert (val["n_tokens"], val["n_blocks"]) == tuple(n)
    # the window reaches to the end of April, the split does not
    whole = build_shards(corpus, E.BuildSpec(**{**E.SPEC.__dict__, "start": P.VAL[0], "end": P.VAL[1]}), str(tmp_path / "whole"))
    assert n[0] < whole.agg(F.sum("n_tokens")).first()[0]
    assert stored["none"].count() == 0 and write_report(stored["none"]).count() == 0


@pytest.mark.parametrize("shuffle", [True, False])
def test_epoch_order_is_each_epochs_sequence(spark, monkeypatch, shuffle):
    monkeypatch.setattr(feed, "KEY_SLICE", 4)  # shards span several slices
    sizes = [("s1", 11), ("s2", 0), ("s3", 4), ("s4", 1), ("s5", 9)]
    man = spark.createDataFrame(sizes, "shard string, n_chunks long")
    got = feed.epoch_order(man, 2, 3, num_workers=2, shuffle_shards=shuffle, shuffle_chunks=shuffle, seed=7)
    rows = sorted(tuple(r) for r in got.collect())
    chunks = spark.createDataFrame([(s, c) for s, n in sizes for c in range(n)], "shard string, chunk long")
    want = []
    for epoch in (0, 1):
        samples = feed.feed_samples(
            chunks, man, num_workers=2, shuffle_shards=shuffle, shuffle_chunks=shuffle, seed=7, epoch=epoch
        )
        cols = ("worker", "batch_id", "pos_in_batch", "shard", "chunk")
        want += [(epoch, *r) for r in feed.assign_batches(samples, 3).select(*cols).collect()]
    assert rows == sorted(want) and len(rows) == 50
    orders = [[r[1:] for r in rows if r[0] == e] for e in (0, 1)]
    assert (orders[0] == orders[1]) is not shuffle


def test_epoch_order_reads_no_arrays_and_checks_its_arguments(spark, tmp_path):
    stored = build_shards(corpus_view(spark, SF_SMALL), E.SPEC, str(tmp_path / "s"))
    plan = plan_of(epoch_orders(stored, FeedSpec(chunk_size=1000, shuffle_chunks=False), 2))
    assert "input_ids" not in plan and "labels" not in plan
    empty = spark.createDataFrame([], "shard string, n_chunks long")
    assert feed.epoch_order(empty, 2, 3, num_workers=2).count() == 0
    with pytest.raises(ValueError):
        feed.epoch_order(empty, 0, 3, num_workers=2)


def test_a_users_tokenizer(spark):
    class Lengths:
        def encode_sides(self, df, keys, src, tgt):
            return df.select(*keys, F.array(F.length(src)).alias("_src"), F.array(F.length(tgt)).alias("_tgt"))

    df = spark.createDataFrame([(1, "abc", "de")], "doc_id long, inputs string, outputs string")
    row = tokenize(df, Lengths(), keys=("doc_id",)).first()
    assert (row.input_ids, row.labels, row.length) == ([3, 2], [-100, 2], 2)
    with pytest.raises(TypeError):
        tokenize(df, object())
