"""Tokens in stream order, packing without a shuffle of ids, masked runs, bounded encoding."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.functions.tokenizer import text_slices
from shardloom.functions.tokens import labels_from_runs
from shardloom.operators.packing import cut_windows, pack_blocks, pack_stream, whole_blocks
from shardloom.operators.streams import in_stream_order, with_place

SCHEMA = "shard string, doc_id long, input_ids array<int>, labels array<int>, length int, n_masked int"


def rows_of(seed, docs, longest):
    rng, rows = random.Random(seed), []
    for i in range(docs):
        n = rng.choice([0, rng.randint(0, longest)])
        m = rng.randint(0, n)
        ids = [rng.randint(0, 1 << 20) for _ in range(n)]
        rows.append((rng.choice(["a", "b", None]), i, ids, [-100] * m + ids[m:], n, m))
    return rows


def packed(rows, B):
    out = {}
    for shard in {r[0] for r in rows}:
        ids = [t for r in sorted(rows, key=lambda r: r[1]) if r[0] == shard for t in r[2]]
        labels = [t for r in sorted(rows, key=lambda r: r[1]) if r[0] == shard for t in r[3]]
        for c in range(0, len(ids), B):
            out[shard, c // B] = (ids[c : c + B], labels[c : c + B])
    return out


def stored(spark, rows, path, max_len=None):
    df = in_stream_order(spark.createDataFrame(rows, SCHEMA).repartition(5), ["shard"], ["doc_id"])
    with_place(df.drop("labels"), ["shard"], ["doc_id"], max_len).write.parquet(path)
    return spark.read.parquet(path)


def found(df):
    got = [((r.shard, r.chunk), (list(r.input_ids), list(r.labels))) for r in df.collect()]
    assert len(got) == len({k for k, _ in got})
    return dict(got)


def test_blocks_and_windows_of_a_stream(spark, tmp_path):
    rows = rows_of(3, 300, 60)
    tok = stored(spark, rows, str(tmp_path / "t"))
    plan = pack_stream(tok, ["shard"], 16)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    blocks = whole_blocks(pack_stream(tok, ["shard"], 16), ["shard"], 16, keep_tail=True)
    assert found(blocks) == packed(rows, 16)
    full = {k: v for k, v in packed(rows, 24).items() if len(v[0]) == 24}
    assert found(cut_windows(blocks, 24, block_size=16)) == full
    assert found(cut_windows(blocks.repartition(7), 24, block_size=16)) == full
    sql = pack_blocks(tok.withColumn("labels", F.lit(None)), ["shard"], ["doc_id"], 24, mask="n_masked")
    assert found(sql) == full


def test_rows_over_the_cap_and_ties(spark, tmp_path):
    rows = rows_of(5, 80, 60)
    tok = stored(spark, rows, str(tmp_path / "t"), max_len=40).where("length <= 40")
    blocks = whole_blocks(pack_stream(tok, ["shard"], 16), ["shard"], 16, keep_tail=True)
    assert found(blocks) == packed([r for r in rows if r[4] <= 40], 16)
    twice = stored(spark, [*rows, rows[0]], str(tmp_path / "u"))
    with pytest.raises(Exception, match="order must be total"):
        pack_stream(twice, ["shard"], 16).collect()


def test_labels_from_runs(spark):
    cases = [([], []), ([5, 6], []), ([5, 6, 7, 8], [0, 2]), ([5, 6, 7, 8, 9], [1, 1, 3, 2]), ([5, 6], [0, 2])]
    df = spark.createDataFrame(cases, "input_ids array<int>, masked array<int>")
    got = [list(r[0]) for r in df.select(labels_from_runs("input_ids", "masked")).collect()]
    assert got == [[], [5, 6], [-100, -100, 7, 8], [5, -100, 7, -100, -100], [-100, -100]]


def test_texts_are_encoded_in_bounded_slices():
    batch = pa.RecordBatch.from_pydict({"a": ["x" * 30, None, "é" * 40, "y"], "b": ["", "z" * 50, "", "w"]})
    parts = list(text_slices(batch, ("a", "b"), 80))
    assert [p.num_rows for p in parts] == [2, 1, 1]
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()


def test_keys_of_windows_move_no_arrays(spark):
    rows = [("a", 1, list(range(40)), list(range(40)), 40, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = pack_blocks(df, ["shard"], ["doc_id"], 8).select("shard", "chunk")
    assert "collect_list" not in keys._jdf.queryExecution().optimizedPlan().toString()
    assert keys.count() == 5
