"""End-to-end plans: build shards, feed from Parquet and from .npy, log report."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from shardloom.functions.tokens import ids_digest
from shardloom.plans.build import build_shards
from shardloom.plans.feed import FeedSpec, feed_batches, feed_from_npy
from shardloom.plans.report import LogSpec, log_report
from shardloom.sources.npy import write_npy_shards
from shardloom.sources.tables import corpus_view, train_log_view
from tests.conftest import SF_SMALL


def digests(batches):
    d = F.md5(F.array_join(F.transform("input_ids", lambda a: ids_digest(a)), ","))
    l = F.md5(F.array_join(F.transform("labels", lambda a: ids_digest(a)), ","))
    return sorted(tuple(r) for r in batches.select("worker", "batch_id", "n_samples", d.alias("d"), l.alias("l")).collect())


def test_parquet_and_npy_feeds_agree(spark, tmp_path):
    stored = build_shards(corpus_view(spark, SF_SMALL), E.SPEC, str(tmp_path / "pq"))
    assert set(stored.columns) >= {"shard", "chunk", "input_ids", "labels", "n_tokens"}
    spec = FeedSpec(chunk_size=1000, batch_size=3, num_workers=3, shuffle_chunks=True, world_size=2, block_size=E.SPEC.block_size)
    from_pq = feed_batches(stored, spec)
    write_npy_shards(stored.select("shard", "chunk", "input_ids", "labels"), str(tmp_path / "npy"))
    from_npy = feed_from_npy(spark, str(tmp_path / "npy"), spec)
    a, b = digests(from_pq), digests(from_npy)
    assert a == b and len(a) > 0
    assert set(from_pq.columns) >= {"rank", "attention_mask"}
    demo = feed_batches(stored, FeedSpec(chunk_size=1000, batch_size=3, num_workers=3, demo_shards=2))
    assert demo.agg(F.sum("n_samples")).first()[0] < from_pq.agg(F.sum("n_samples")).first()[0]


def test_log_report(spark):
    log = train_log_view(spark, SF_SMALL)
    rep = log_report(log, LogSpec(accum=4, update_freq=5, seq_len=128, procs=2, micro_batch=2, demo_steps=3))
    assert rep["windows"].count() > 0 and rep["progress"].count() > 0
    assert rep["demo"].agg(F.max("opt_step")).first()[0] == 4


def test_token_table_scan_is_pushed_and_pruned(spark):
    from shardloom.operators.packing import with_offsets
    from shardloom.plans.build import materialized_tokens

    tok = materialized_tokens(corpus_view(spark, SF_SMALL), E._spec(spark))
    narrow = with_offsets(tok, ["shard"], ["doc_id"])
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,64000)" in plan  # cap is a Parquet filter
    scans = [line for line in plan.split("\n") if "ReadSchema" in line or "FileScan" in line]
    assert scans and all("input_ids" not in line for line in scans)  # offsets read narrow columns only


def test_no_tokenisation_below_the_spreading_exchange(spark):
    from shardloom.plans.build import spread, token_table

    tok = token_table(spread(corpus_view(spark, SF_SMALL), 4), E.SPEC, max_len=None)
    plan = tok._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(doc_id")[1]
    assert "split(" not in below and "regexp_replace" not in below
