"""Per-rank delivery files: order, resume, one payload exchange, unfinished folders."""

from __future__ import annotations

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardloom.operators import feed
from shardloom.sources.delivery import delivery_index, placed_samples, rank_files, read_rank, write_delivery

BATCH, WORLD, PER_FILE = 3, 2, 4


def _samples(spark, sizes={0: 40, 1: 7, 2: 0, 3: 1}):
    """(worker, seq, input_ids, labels): workers of very different lengths."""
    rows = [(w, s, [w, s, 5], [-100, s, 5]) for w, n in sizes.items() for s in range(n)]
    samples = spark.createDataFrame(rows, "worker int, seq long, input_ids array<int>, labels array<int>")
    chunks = spark.createDataFrame(list(sizes.items()), "worker int, n_chunks long")
    return samples.repartition(5), feed.worker_batches(chunks, BATCH)


def _write(spark, path, **over):
    samples, counts = _samples(spark)
    return write_delivery(samples, counts, path, **{"batch_size": BATCH, "world_size": WORLD, "per_file": PER_FILE, **over})


def _round_robin(sizes):
    """Replay: workers in turn, an exhausted one skipped."""
    left = {w: -(-n // BATCH) for w, n in sizes.items()}
    taken, out = dict.fromkeys(sizes, 0), []
    while any(taken[w] < left[w] for w in left):
        for w in sorted(left):
            if taken[w] < left[w]:
                out.append((w, taken[w]))
                taken[w] += 1
    return out


def test_files_in_name_order_are_the_stream(spark, tmp_path):
    path = str(tmp_path / "out")
    index = _write(spark, path)
    expected = _round_robin({0: 40, 1: 7, 2: 0, 3: 1})
    assert index.agg(F.sum("n_batches")).first()[0] == len(expected)
    for rank in range(WORLD):
        got = []
        for f in rank_files(spark, path, rank).collect():
            folder = os.path.join(path, f["folder"])
            files = [n for n in os.listdir(folder) if n.endswith(".parquet")]
            assert len(files) == 1 and f["n_batches"] <= PER_FILE and f["skip"] == 0
            table = pq.ParquetFile(os.path.join(folder, files[0])).read()
            assert table.num_rows == f["n_batches"]
            got += zip(table["worker"].to_pylist(), table["batch_id"].to_pylist(), table["input_ids"].to_pylist(), strict=True)
        assert [(w, b) for w, b, _ in got] == expected[rank::WORLD]
        for w, b, ids in got:
            assert [s for _, s, _ in ids] == list(range(b * BATCH, b * BATCH + len(ids))) and {x for x, _, _ in ids} == {w}


def test_resume_reads_only_later_files(spark, tmp_path):
    path = str(tmp_path / "out")
    _write(spark, path)
    expected = _round_robin({0: 40, 1: 7, 2: 0, 3: 1})[1::WORLD]
    rest = read_rank(spark, path, 1, 5)
    assert [(r["worker"], r["batch_id"]) for r in rest.orderBy("slot").collect()] == expected[5:]
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*rank.*part", plan) and "PushedFilters: [IsNotNull(slot)" in plan
    files = {r[0] for r in rest.select("_metadata.file_path").collect()}
    assert files and not any("part=0000000000" in f or "rank=0" in f for f in files)
    first = rank_files(spark, path, 1, 5).first()
    assert (first["folder"], first["skip"]) == ("batches/rank=1/part=0000000001", 1)
    assert read_rank(spark, path, 1, 10**6).count() == 0 and read_rank(spark, path, WORLD).count() == 0


def test_arrays_cross_one_exchange(spark):
    samples, counts = _samples(spark)
    rows = placed_samples(samples.coalesce(1), counts, BATCH, WORLD, PER_FILE)
    keys = ["rank", "part", "slot", "delivery", "worker", "batch_id"]
    plan = feed.gather_batches(rows.repartition("rank", "part"), keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(rank") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_unfinished_and_repeated_exports_fail(spark, tmp_path):
    path = str(tmp_path / "out")
    samples, counts = _samples(spark)
    lost = samples.where("NOT (worker = 0 AND seq BETWEEN 9 AND 11)")  # one whole batch
    with pytest.raises(ValueError, match="holds 17 of 18"):
        write_delivery(lost, counts, path, batch_size=BATCH, world_size=WORLD, per_file=PER_FILE)
    with pytest.raises(ValueError, match="index is missing"):
        read_rank(spark, path, 0)
    with pytest.raises(Exception, match="(?i)already exists"):
        _write(spark, path)
    whole = str(tmp_path / "whole")
    _write(spark, whole)
    with pytest.raises(Exception, match="(?i)already exists"):
        _write(spark, whole)
    assert delivery_index(spark, whole).count() > 1 and read_rank(spark, whole, 0).count() == 9


def test_parameters_are_checked(spark, tmp_path):
    for bad in ({"per_file": 0}, {"world_size": 0}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            _write(spark, str(tmp_path / "x"), **bad)
