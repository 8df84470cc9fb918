"""Ids stored as bytes, keys spread over tasks, ranks looked up without moving arrays, shards written where they lie."""

from __future__ import annotations

import __spark_entry__ as E
import pyarrow as pa
from pyspark.sql import functions as F

from shardloom.functions.tokenizer import CodePointTokenizer
from shardloom.functions.tokens import PACKED, _unpacked, packed_ids
from shardloom.operators import feed
from shardloom.operators.packing import cut_windows, pack_stream, whole_blocks
from shardloom.operators.streams import in_stream_order, tokens_in_place
from shardloom.plans.build import materialized_tokens, packed_shards, write_shards
from shardloom.sources.tables import corpus_view

SF_SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_ids_and_back():
    import numpy as np

    flat = np.array([1, -100, 1 << 20, 7], np.int32)
    packed = packed_ids(flat, [0, 3, 3, 3, 4], [False, False, True, False])
    assert _unpacked(packed).to_pylist() == [[1, -100, 1 << 20], [], None, [7]]
    assert _unpacked(packed.slice(1)).to_pylist() == [[], None, [7]]
    assert _unpacked(pa.array([], pa.binary())).to_pylist() == []


def test_stream_of_packed_ids_is_the_same(spark, tmp_path):
    texts = [(i, "ab"[i % 2] if i % 7 else None, "é" * (i % 5), "𝄞x\n" * (i % 9)) for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id long, shard string, inputs string, outputs string").repartition(3)
    got = []
    for packed in (False, True):
        tok = tokens_in_place(
            in_stream_order(df, ["shard"], ["doc_id"]), CodePointTokenizer(), ("doc_id", "shard"), ["shard"], ["doc_id"], 25, packed=packed
        )
        tok.write.parquet(path := str(tmp_path / str(packed)))
        blocks = whole_blocks(pack_stream(spark.read.parquet(path).where("length <= 25"), ["shard"], 16), ["shard"], 16, keep_tail=True)
        assert (PACKED in blocks.columns) == packed
        windows = cut_windows(blocks.repartition(5), 24, block_size=16)
        got.append([sorted(map(repr, t.select("shard", "chunk", "input_ids", "labels").collect())) for t in (blocks, windows)])
    assert got[0] == got[1] and all(got[0])


def test_stored_tokens_and_blocks_hold_bytes(spark):
    tok = materialized_tokens(corpus_view(spark, SF_SMALL), E._spec(spark))
    blocks = packed_shards(tok, E.SPEC)
    for table in (tok, blocks):
        assert dict(table.dtypes)[PACKED] == "binary" and dict(table.dtypes)["input_ids"] == "array<int>"
    assert "ArrowEvalPython" not in plan_of(blocks.select("shard", "n_tokens"))  # arrays are made for their readers alone
    r = tok.where("doc_id = 3").select("input_ids", "length").first()
    assert len(r.input_ids) == r.length


def test_keys_are_unfolded_by_several_tasks(spark):
    manifest = spark.createDataFrame([(f"s{i}", 3) for i in range(40)], "shard string, n_chunks long")
    assert feed.chunk_keys(manifest, "shard").select(F.spark_partition_id()).distinct().count() > 1


def test_ranks_are_looked_up_without_moving_chunks(spark, monkeypatch):
    sizes = {"a": 11, "b": 4, "c": 0, "d": 1}
    manifest = spark.createDataFrame(list(sizes.items()), "shard string, n_chunks long")
    rows = [(s, c, [c]) for s, n in sizes.items() for c in range(n)]
    chunks = spark.createDataFrame(rows, "shard string, chunk long, input_ids array<int>")
    more = chunks.unionByName(spark.createDataFrame([("a", 11, [0]), ("e", 0, [0]), (None, 0, [0])], chunks.schema))
    expected = sorted(feed.order_chunks(chunks, shuffle=True, seed=3).collect())
    monkeypatch.setattr(feed, "RANK_SLICE", 4)
    for most in (100, 1):
        monkeypatch.setattr(feed, "RANK_SLICES", most)
        ranked = feed.order_chunks(more, shuffle=True, seed=3, manifest=manifest)
        assert sorted(ranked.select("shard", "chunk", "input_ids", "chunk_rank").collect()) == expected
        assert most == 1 or "hashpartitioning(shard" not in plan_of(ranked)


def test_windows_are_cut_once_for_their_order(spark):
    assert "MapInArrow" not in plan_of(E.q_chunk_shuffle(spark, SF_SMALL))


def test_blocks_in_order_are_written_where_they_are_read(spark, tmp_path, monkeypatch):
    blocks = packed_shards(materialized_tokens(corpus_view(spark, SF_SMALL), E._spec(spark)), E.SPEC)
    columns = ["shard", "chunk", "input_ids", "labels", "n_tokens"]
    expected = sorted(map(repr, blocks.select(*columns).collect()))
    with monkeypatch.context() as m:
        m.setattr(type(blocks), "repartitionByRange", None)
        write_shards(blocks, str(tmp_path / "s"), in_order=True)
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(repr, stored.select(*columns).collect())) == expected
