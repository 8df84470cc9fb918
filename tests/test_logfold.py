"""Folding log slices in gives the windows of the whole log."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shardloom.operators import logfold, trainlog

ACCUM, FREQ, TOKENS = 4, 3, 100
RULE = logfold.FoldRule(ACCUM, FREQ, TOKENS, n_ranks=2)
SCHEMA = "rank long, epoch int, step int, loss double, ts timestamp"


def _rows(epochs=(30, 17, 41), odd=()):
    rows, t0 = [], dt.datetime(2024, 1, 1)
    for rank in range(2):
        k = 0
        for e, n in enumerate(epochs):
            for s in range(n):
                k += 1
                loss = None if (rank, e, s) in odd else (k * 37 % 101) / 7
                rows.append((rank, e, s, loss, t0 + dt.timedelta(seconds=3 * k + rank)))
    return rows


def _plain(df):
    cols = sorted(df.columns)
    return sorted(tuple(repr(r[c]) for c in cols) for r in df.select(*cols).collect())


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_slices_give_the_windows_of_the_whole_log(spark, tmp_path, seed):
    rows = _rows(odd={(1, 1, 5)})
    rng, path = random.Random(seed), str(tmp_path / "log")
    by_rank = [[r for r in rows if r[0] == k] for k in range(2)]
    at, done = [0, 0], []
    while any(at[k] < len(by_rank[k]) for k in range(2)):  # ranks advance by unlike amounts
        part = []
        for k in range(2):
            n = rng.randrange(0, 60)
            part += by_rank[k][at[k] : at[k] + n]
            at[k] += n
        rng.shuffle(part)
        done += _plain(logfold.fold(_frame(spark, part), path, RULE))
    logfold.fold(_frame(spark, []), path, RULE, finish=True)
    whole = trainlog.loss_windows(_frame(spark, rows), ACCUM, FREQ, TOKENS)
    assert _plain(logfold.folded_windows(spark, path)) == _plain(whole) and whole.count() == 8
    assert set(done) <= set(_plain(whole))
    assert whole.where(F.isnan("mean_loss")).count() == 1


def test_open_windows_wait_for_the_slowest_rank(spark, tmp_path):
    path, rows = str(tmp_path / "log"), _rows((24,))
    assert logfold.fold(_frame(spark, [r for r in rows if r[0] == 0]), path, RULE).count() == 0
    got = logfold.fold(_frame(spark, [r for r in rows if r[0] == 1 and r[2] < 13]), path, RULE)
    assert [r["log_window"] for r in got.collect()] == [0]
    state = spark.read.parquet(logfold._folder(path, 2, "open"))
    assert state.agg(F.sum("micro_steps")).first()[0] == 12 + 1  # nothing of window 0 is kept
    assert state.select("sync").distinct().count() == 3


def test_repeated_and_broken_slices_fail_and_leave_the_state(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "log"), _rows((30, 9))
    first, second = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
    with pytest.raises(ValueError, match="no folded log"):
        logfold.folded_windows(spark, path)
    logfold.fold(_frame(spark, first), path, RULE)
    before = _plain(logfold.folded_windows(spark, path))
    with pytest.raises(ValueError, match="is in up to"):
        logfold.fold(_frame(spark, first[-3:]), path, RULE)
    with pytest.raises(ValueError, match="not among"):
        logfold.fold(_frame(spark, [(7, 1, 0, 1.0, dt.datetime(2024, 2, 1))]), path, RULE)
    with pytest.raises(ValueError, match="has no rank"):
        logfold.fold(_frame(spark, [(None, 1, 0, 1.0, dt.datetime(2024, 2, 1))]), path, RULE)
    real = logfold.window_rows
    monkeypatch.setattr(logfold, "window_rows", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        logfold.fold(_frame(spark, second), path, RULE, finish=True)
    monkeypatch.setattr(logfold, "window_rows", real)
    assert _plain(logfold.folded_windows(spark, path)) == before
    logfold.fold(_frame(spark, second), path, RULE, finish=True)  # the same slice again
    whole = trainlog.loss_windows(_frame(spark, rows), ACCUM, FREQ, TOKENS)
    assert _plain(logfold.folded_windows(spark, path)) == _plain(whole)
