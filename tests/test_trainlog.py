"""G5-G10 against a plain replay of the training loop's counters."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from pyspark.sql import functions as F

from shardloom.operators import trainlog

T0 = dt.datetime(2024, 1, 1)


def make_log(spark, epochs_len, ranks=2, seed=1):
    rng = random.Random(seed)
    rows, t = [], 0
    for e, n in enumerate(epochs_len):
        for s in range(n):
            t += rng.randint(1, 9)
            for r in range(ranks):
                rows.append((r, e, s, round(rng.uniform(0.5, 3.0), 4), T0 + dt.timedelta(seconds=t, microseconds=r)))
    return rows, spark.createDataFrame(rows, "rank long, epoch int, step int, loss double, ts timestamp_ntz")


def replay(rows, epochs_len, accum, uf, ranks=2, demo=None):
    loss = {(r, e, s): lo for r, e, s, lo, _ in rows}
    ts = {(0, e, s): t for r, e, s, _lo, t in rows if r == 0}
    g, acc, tot, logs, done = 0, 0, 0.0, [], []
    for e, n in enumerate(epochs_len):
        for s in range(n):
            if demo is not None and g > demo:
                break
            done.append((e, s))
            tot += sum(loss[(r, e, s)] for r in range(ranks))
            acc += 1
            if (s + 1) % accum == 0 or s == n - 1:
                g += 1
                if g % uf == 0:
                    logs.append(dict(epoch=e, end_step=s, global_step=g, mean=tot / acc / ranks, steps=acc, ts=ts[(0, e, s)]))
                    tot, acc = 0.0, 0
    return logs, done


@pytest.mark.parametrize("epochs_len,accum,uf", [([50, 50], 4, 3), ([37, 41, 12], 5, 2), ([10], 16, 5)])
def test_windows_match_replay(spark, epochs_len, accum, uf):
    rows, log = make_log(spark, epochs_len)
    expect, _ = replay(rows, epochs_len, accum, uf)
    got = sorted(trainlog.loss_windows(log, accum, uf, tokens_per_step=100).collect(), key=lambda r: r.log_window)
    assert len(got) == len(expect)  # fewer steps than one window -> no rows
    for g, e in zip(got, expect):
        assert (g.epoch, g.end_step, g.global_step, g.micro_steps) == (e["epoch"], e["end_step"], e["global_step"], e["steps"])
        assert math.isclose(g.mean_loss, e["mean"], rel_tol=1e-12)
        assert math.isclose(g.perplexity, math.exp(min(e["mean"], 20)), rel_tol=1e-12)


def test_throughput_elapsed_resets_at_epoch(spark):
    epochs_len = [20, 20]
    rows, log = make_log(spark, epochs_len)
    got = sorted(trainlog.loss_windows(log, 4, 2, tokens_per_step=1000).collect(), key=lambda r: r.log_window)
    starts = {e: min(t for r, ee, s, _lo, t in rows if r == 0 and ee == e) for e in range(2)}
    prev = None
    for g in got:
        since = max(prev or starts[g.epoch], starts[g.epoch])
        logged = [t for r, e, s, _lo, t in rows if r == 0 and e == g.epoch and s == g.end_step][0]
        el = (logged - since).total_seconds()
        assert math.isclose(g.elapsed_sec, el)
        assert math.isclose(g.tokens_per_sec, 1000 * g.micro_steps / el if el > 0 else 0.0)
        prev = logged


def test_perplexity_clamp(spark):
    rows = [(0, 0, s, 50.0, T0 + dt.timedelta(seconds=s)) for s in range(4)]
    log = spark.createDataFrame(rows, "rank long, epoch int, step int, loss double, ts timestamp_ntz")
    r = trainlog.loss_windows(log, 2, 1, 10).first()
    assert r.mean_loss == 50.0 and math.isclose(r.perplexity, math.exp(20))


def test_zero_update_freq_raises(spark):
    _, log = make_log(spark, [5])
    with pytest.raises(ValueError):
        trainlog.assign_steps(log, 4, 0)
    with pytest.raises(ValueError):
        trainlog.assign_steps(log, 0, 2)


def test_demo_cut_matches_replay(spark):
    epochs_len = [30, 30]
    rows, log = make_log(spark, epochs_len)
    _, done = replay(rows, epochs_len, 4, 1, demo=3)
    got = sorted({(r.epoch, r.step) for r in trainlog.demo_cut(log, 4, 3).collect()})
    assert got == done  # n + 1 optimizer steps, later epochs empty


def test_progress_rows(spark):
    rows, log = make_log(spark, [120], ranks=1)
    got = sorted(trainlog.progress_rows(log, 10, 120).collect(), key=lambda r: r.step)
    assert [r.step for r in got] == [50, 100]
    r = got[0]
    assert r.processed_tokens == 510 and r.pct == round(510 * 100 / 1200, 4)
    t = (rows[50][4] - rows[0][4]).total_seconds()
    assert r.elapsed == f"{int(t // 3600):02d}:{int((t % 3600) // 60):02d}:{t % 60:05.2f}"
    # global step at a progress line = optimizer steps completed before it
    _rows2, log2 = make_log(spark, [60, 60], ranks=1)
    steps = {(r.epoch, r.step): r.global_step for r in trainlog.progress_rows(log2, 10, 60, accum=7).collect()}
    assert steps == {(0, 50): 50 // 7, (1, 50): -(-60 // 7) + 50 // 7}


def test_stream_window_size_closed_form():
    from shardloom.streaming.loss_windows import window_size

    for E_, n_ep, acc, uf in ((2500, 2, 16, 10), (37, 3, 5, 2), (10, 1, 16, 5), (64, 2, 8, 3)):
        syncs = -(-E_ // acc)
        sizes = {}
        for e in range(n_ep):
            for g in range(syncs):
                opt = e * syncs + g + 1
                sizes[(opt - 1) // uf] = sizes.get((opt - 1) // uf, 0) + (acc if g < syncs - 1 else E_ - acc * (syncs - 1))
        full = {w: n for w, n in sizes.items() if (w + 1) * uf <= n_ep * syncs}
        for w in range(-1, max(sizes) + 3):
            assert window_size(w, E_, n_ep, acc, uf) == full.get(w)


def test_loss_windows_come_from_one_rollup(spark):
    """The result's plan reads the written rollup and epoch table, never the log."""
    log = spark.createDataFrame([(r, 0, s, 1.0) for r in (0, 1) for s in range(8)], "rank long, epoch int, step int, loss double")
    log = log.withColumn("ts", F.timestamp_seconds(F.col("step").cast("long")))
    out = trainlog.loss_windows(log, 2, 2, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "ExistingRDD" not in plan and "LocalTableScan" not in plan
    assert sorted((r.log_window, r.micro_steps, r.mean_loss) for r in out.collect()) == [(0, 4, 1.0), (1, 4, 1.0)]


def test_null_loss_is_not_a_step_of_loss_zero(spark):
    from shardloom.operators import trainlog

    rows = [(0, 0, s, None if s == 1 else 1.0, f"2024-01-01 00:00:{s:02d}") for s in range(8)]
    log = spark.createDataFrame(rows, "rank int, epoch int, step int, loss double, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r["log_window"]: r for r in trainlog.loss_windows(log, 2, 2, 10).collect()}
    assert got[0]["mean_loss"] != got[0]["mean_loss"] and got[0]["perplexity"] != got[0]["perplexity"]
    assert got[1]["mean_loss"] == 1.0 and got[0]["micro_steps"] == 4


def test_epoch_plan_from_the_summary_row(spark):
    from shardloom.operators import stats

    man = spark.createDataFrame([("shard_a", 1000), ("shard_b", 500)], "shard string, n_tokens long")
    columns = "name string, seq_len int, micro_batch int, procs int, accum int, epochs int, warmup_ratio double, log_ratio double, demo_ratio double"
    configs = spark.createDataFrame([("a", 10, 4, 2, 3, 2, 0.1, 0.2, 0.3), ("b", 7, 1, 1, 1, 1, 0.0, 0.0, 0.0)], columns)
    joined, given = (stats.epoch_plan(x, configs).collect() for x in (stats.corpus_summary(man, 10), 1500))
    assert sorted(joined) == sorted(given) and {r["est_chunks"] for r in joined} == {150, 214}
    empty = stats.epoch_plan(stats.corpus_summary(man.limit(0), 10), configs)
    assert {r["est_chunks"] for r in empty.collect()} == {0}
