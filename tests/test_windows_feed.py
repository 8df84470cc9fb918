"""W1-W9, S1-S5, S9, J1, J2, G1, G2, G4."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardloom.operators import feed, stats
from shardloom.operators.limits import sample_limit
from shardloom.operators.windows import assign_windows, date_windows, filter_label_prefix, scan_window, split_by_dates
from shardloom.sources.tables import run_config


def add_months(d: dt.date, m: int) -> dt.date:
    y, mo = divmod(d.month - 1 + m, 12)
    y += d.year
    mo += 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][mo - 1]
    return dt.date(y, mo, min(d.day, last))


def python_windows(start, end, step):
    out, k = [], 0
    while add_months(start, k * step) < end:
        out.append((add_months(start, k * step), add_months(start, (k + 1) * step)))
        k += 1
    return out


def test_reference_window_grid(spark):
    w = date_windows(spark, "2015-03-01", "2018-06-30", 2).orderBy("window_idx").collect()
    assert len(w) == 20
    assert (str(w[-1].window_start), str(w[-1].window_end)) == ("2018-05-01", "2018-07-01")  # not clamped
    assert w[0].shard == "shard_2015-03-01_2015-05-01"


@pytest.mark.parametrize(
    "start,end,step",
    [("2015-03-01", "2015-08-15", 2), ("2016-01-10", "2016-12-31", 3), ("2015-03-01", "2015-03-01", 2), ("2016-05-01", "2016-01-01", 1)],
)
def test_windows_match_month_arithmetic(spark, start, end, step):
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    got = [(r.window_start, r.window_end) for r in date_windows(spark, start, end, step).orderBy("window_idx").collect()]
    assert got == python_windows(s, e, step)


def test_assign_windows_every_row_once(spark):
    days = [dt.date(2015, 3, 1) + dt.timedelta(days=i) for i in range(0, 1300, 3)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "doc_id long, d date")
    got = {r.doc_id: (r.window_start, r.window_end) for r in assign_windows(df, "d", "2015-03-01", "2018-06-30", 2).collect()}
    wins = python_windows(dt.date(2015, 3, 1), dt.date(2018, 6, 30), 2)
    for i, d in enumerate(days):
        hit = [w for w in wins if w[0] <= d < w[1]]
        assert got.get(i) == (hit[0] if hit else None)


def test_scan_filter_split_and_pushdown(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, dt.date(2016, 1, 5), "EN01"), (2, dt.date(2016, 3, 2), "FR02"), (3, dt.date(2016, 5, 1), "EN03")],
        "doc_id long, d date, ipc_label string",
    )
    path = str(tmp_path / "c")
    df.write.parquet(path)
    src = spark.read.parquet(path)
    scanned = scan_window(src, "d", "2016-01-01", "2016-03-02")
    assert [r.doc_id for r in scanned.collect()] == [1]
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d," in scanned._jdf.queryExecution().executedPlan().toString()
    assert [r.doc_id for r in filter_label_prefix(src, "EN").orderBy("doc_id").collect()] == [1, 3]
    assert filter_label_prefix(src, None).count() == 3
    split = {r.doc_id: r.split for r in split_by_dates(src, "d", ("2016-01-01", "2016-02-01"), ("2016-03-01", "2016-04-01")).collect()}
    assert split == {1: "train", 2: "val"}


def test_sample_limit_per_group(spark):
    df = spark.createDataFrame([(g, i) for g in "ab" for i in range(10)], "g string, i long")
    got = sorted((r.g, r.i) for r in sample_limit(df, 3, ["i"], ["g"]).collect())
    assert got == [(g, i) for g in "ab" for i in range(3)]
    assert sample_limit(df, 0, ["i"]).count() == 20
    assert [r.i for r in sample_limit(df, 2, ["i"]).collect()] == [0, 0]


def manifest(spark, sizes, chunk):
    rows = [(f"shard_{i:02d}", n, n) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "shard string, n_tokens long, n_labels long").withColumn(
        "n_chunks", F.expr(f"n_tokens div {chunk}")
    )


def chunk_rows(spark, man):
    rows = [(r.shard, c, [c], [c]) for r in man.collect() for c in range(r.n_chunks)]
    return spark.createDataFrame(rows, "shard string, chunk long, input_ids array<int>, labels array<int>")


@pytest.mark.parametrize("sizes,workers,batch", [([40, 8, 25], 5, 2), ([33], 3, 4), ([16, 16, 16, 16, 9], 2, 3)])
def test_every_chunk_once_and_batches(spark, sizes, workers, batch):
    man = manifest(spark, sizes, 4)
    chunks = chunk_rows(spark, man)
    samples = feed.feed_samples(chunks, man, num_workers=workers, shuffle_shards=True, shuffle_chunks=True)
    rows = samples.collect()
    assert sorted((r.shard, r.chunk) for r in rows) == sorted((r.shard, r.chunk) for r in chunks.collect())
    per_worker = {}
    for r in rows:
        per_worker.setdefault(r.worker, []).append(r.seq)
    for seqs in per_worker.values():
        assert sorted(seqs) == list(range(len(seqs)))  # dense sequence per worker
    batches = feed.stack_batches(samples, batch).collect()
    for w, seqs in per_worker.items():
        sizes_w = sorted((b.batch_id, b.n_samples) for b in batches if b.worker == w)
        full, rest = divmod(len(seqs), batch)
        assert [n for _, n in sizes_w] == [batch] * full + ([rest] if rest else [])  # partial last batch kept
    b = batches[0]
    assert all(list(m) == [1] * len(i) for m, i in zip(b.attention_mask, b.input_ids))
    ranks = feed.split_ranks(feed.assign_batches(samples, batch), 2).select("batch_id", "rank").distinct().collect()
    assert all(r.rank == r.batch_id % 2 for r in ranks)


def test_striping_and_first_shards(spark):
    man = manifest(spark, [4] * 7, 4)
    got = {r.shard: r.worker for r in feed.stripe_workers(man, 3).collect()}
    assert got == {f"shard_{i:02d}": i % 3 for i in range(7)}
    assert [r.shard for r in feed.first_shards(man, 2).collect()] == ["shard_00", "shard_01"]
    # no shuffle keeps name order inside a worker; hash order is epoch-aware
    plain = feed.order_shards(feed.stripe_workers(man, 2), shuffle=False).collect()
    assert all(r.shard_rank == int(r.shard[-2:]) // 2 for r in plain)
    e0 = [r.shard for r in feed.order_shards(feed.stripe_workers(man, 1), epoch=0).orderBy("shard_rank").collect()]
    e1 = [r.shard for r in feed.order_shards(feed.stripe_workers(man, 1), epoch=1).orderBy("shard_rank").collect()]
    assert sorted(e0) == sorted(e1) and e0 != e1


def test_empty_manifest_raises(spark):
    with pytest.raises(ValueError, match="lists no shard"):
        feed.require_shards(manifest(spark, [4], 4).where("false"))


def test_pairing_and_length_check(spark):
    ids = spark.createDataFrame([("a", 10), ("b", 5), ("c", 7)], "shard string, n_tokens long")
    labs = spark.createDataFrame([("a", 10), ("c", 6), ("d", 3)], "shard string, n_tokens long")
    got = {r.shard: r.status for r in feed.pair_shards(ids, labs).collect()}
    assert got == {"a": "ok", "b": "missing_labels", "c": "length_mismatch", "d": "missing_ids"}
    man = spark.createDataFrame([("a", 10, 10), ("c", 7, 6)], "shard string, n_tokens long, n_labels long")
    assert {r.shard: r.lengths_match for r in feed.check_lengths(man).collect()} == {"a": True, "c": False}
    with pytest.raises(ValueError, match="lengths differ"):
        feed.check_lengths(man, strict=True)


def test_npy_manifest_formula(spark):
    listing = spark.createDataFrame([("p1", 128 + 4 * 1000), ("p2", 131)], "path string, length long")
    assert {r.path: r.n_tokens for r in feed.npy_manifest(listing).collect()} == {"p1": 1000, "p2": 0}


def test_shard_totals_and_summary(spark):
    tok = spark.createDataFrame(
        [("shard_2015-03-01_2015-05-01", 1, 1234567), ("shard_2015-03-01_2015-05-01", 2, 1), ("shard_2015-05-01_2015-07-01", 3, 5)],
        "shard string, doc_id long, length int",
    )
    g1 = {r.shard: r for r in stats.shard_token_totals(tok).collect()}
    r = g1["shard_2015-03-01_2015-05-01"]
    assert r.total_tokens_fmt == "1,234,568"
    assert r.description == "Total tokens 1,234,568\nStart date 2015-03-01, end date 2015-05-01"
    man = tok.groupBy("shard").agg(F.sum("length").alias("n_tokens"))
    s = stats.corpus_summary(man, 1000).first()
    assert (s.n_shards, s.tokens_per_shard, s.total_tokens, s.n_chunks) == (2, "1234568,5", 1234573, 1234)


def test_epoch_plan_demo_row(spark):
    cfg = run_config(spark, [("demo", 1, 8, 16, 3968, 1, 0.05, 0.1, 0.2), ("two", 2, 8, 16, 3968, 2, 0.05, 0.1, 0.2)])
    plan = {r.name: r for r in stats.epoch_plan(3968 * 1000 + 5, cfg).collect()}
    d = plan["demo"]
    assert d.tokens_per_step == 507_904  # 8 * 16 * 3968 * 1
    assert (d.est_chunks, d.loader_len, d.opt_steps_per_epoch) == (1000, 125, 7)
    assert (d.warmup_steps, d.log_interval, d.demo_steps) == (0, 0, 1)
    t = plan["two"]
    assert (t.loader_len_split, t.samples_per_epoch, t.samples_per_epoch_split) == (63, 2000, 1008)
    assert t.total_opt_steps == 6


def test_delivery_order_round_robin(spark):
    counts = {0: 3, 1: 1, 2: 2}
    rows = [(w, b) for w, n in counts.items() for b in range(n)]
    got = {(r.worker, r.batch_id): r.delivery for r in feed.delivery_order(spark.createDataFrame(rows, "worker int, batch_id long")).collect()}
    # replay: take one batch from each worker in turn, skipping exhausted ones
    order, nxt = [], {w: 0 for w in counts}
    while len(order) < len(rows):
        for w in sorted(counts):
            if nxt[w] < counts[w]:
                order.append((w, nxt[w]))
                nxt[w] += 1
    assert got == {k: i for i, k in enumerate(order)}
