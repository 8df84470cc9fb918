"""Blocks in stream order are exported where they lie; stored tables and shuffle files go with their last reader."""

from __future__ import annotations

import os
import time
from glob import glob

import __spark_entry__ as E
import pytest

from shardloom.functions.tokenizer import CodePointTokenizer
from shardloom.functions.tokens import PACKED
from shardloom.operators.packing import pack_stream, whole_blocks
from shardloom.operators.streams import in_stream_order, tokens_in_place
from shardloom.plans.build import materialized_tokens
from shardloom.session import drop_stored, ensure_checkpoint_dir, materialize
from shardloom.sources.npy import npy_index, npy_totals, read_npy_shards, verify_npy, write_npy_shards
from shardloom.sources.tables import corpus_from_documents

BLOCK = 16


def stored_blocks(spark, packed=True):
    texts = [(i, f"shard_{'abc'[i % 3]}", "é" * (i % 5), "𝄞x\n" * (i % 9)) for i in range(150)]
    prompts = spark.createDataFrame(texts, "doc_id long, shard string, inputs string, outputs string")
    tok = tokens_in_place(in_stream_order(prompts, ["shard"], ["doc_id"]), CodePointTokenizer(), ("doc_id", "shard"), ["shard"], ["doc_id"], None, packed=packed)
    pieces = materialize(pack_stream(materialize(tok.repartition(5, "place_part"), "tokens"), ["shard"], BLOCK), "shards")
    return whole_blocks(pieces, ["shard"], BLOCK, keep_tail=True)


def documents(spark, n=60):
    rows = [(i, f"text {i}\n" * (20 + i), "en", "web") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("packed, most", [(True, 400), (False, 1 << 26)])
def test_blocks_in_order_are_exported_where_they_lie(spark, tmp_path, monkeypatch, packed, most):
    blocks = stored_blocks(spark, packed)
    assert (PACKED in blocks.columns) == packed
    expected = {(r["shard"], r["chunk"]): (r["input_ids"], r["labels"]) for r in blocks.collect()}
    path = str(tmp_path / "npy")
    with monkeypatch.context() as m:
        m.setattr(type(blocks), "repartitionByRange", None)
        m.setattr(type(blocks), "sortWithinPartitions", None)
        write_npy_shards(blocks, path, most, in_order=True)
    if packed:
        assert {r["status"] for r in verify_npy(spark, path).collect()} == {"ok"}
    totals = {r["shard"]: r["n_tokens"] for r in npy_totals(spark, path).collect()}
    assert totals == {s: sum(len(ids) for (shard, _), (ids, _) in expected.items() if shard == s) for s, _ in expected}
    got = {(r["shard"], r["chunk"]): (r["input_ids"], r["labels"]) for r in read_npy_shards(spark, path, BLOCK).collect()}
    assert got == {k: v for k, v in expected.items() if len(v[0]) == BLOCK}  # the reader drops each shard's tail
    assert any(-100 in labels for _, labels in got.values())
    if most == 400:
        assert npy_index(spark, path).where(f"n >= {most + BLOCK}").count() == 0


def test_export_leaves_arrays_alone(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:") + "/shardloom"
    before = set(glob(f"{scratch}/*"))
    totals = E.q_npy_manifest(spark, str(tmp_path)).collect()
    kinds = {os.path.basename(f).rsplit("-", 1)[0] for f in set(glob(f"{scratch}/*")) - before}
    assert kinds == {"npy", "npy-index"}
    tokens = materialized_tokens(corpus_from_documents(documents(spark)), E._spec(spark))
    sums = tokens.groupBy("shard").sum("length").collect()
    assert sorted(map(tuple, totals)) == sorted(map(tuple, sums)) and totals


def test_drop_stored_spares_what_is_read_on(spark):
    first, second = materialize(spark.range(5), "a"), materialize(spark.range(7), "b")
    drop_stored(first.union(second), keep=second)
    assert not glob(first.inputFiles()[0].removeprefix("file://")) and second.count() == 7


def test_stored_tokens_leave_no_shuffle_files(spark):
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    before = {f for d in dirs for f in glob(f"{d}/*/shuffle_*")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key)
    tokens = materialized_tokens(corpus_from_documents(documents(spark)), E._spec(spark))
    for _ in range(40):
        left = {f for d in dirs for f in glob(f"{d}/*/shuffle_*")} - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(key) == held
    assert tokens.count() == 60
