"""A1-A8, P11, P12, G3 and the two-level running totals."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from shardloom.functions.tokenizer import length_filter, tokenize
from shardloom.functions.tokens import attention_mask, code_points, narrow_ids, wide_ids
from shardloom.operators.ordering import ordinal, running_total
from shardloom.operators.packing import chunk_estimate, cut_windows, flatten_tokens, pack_blocks

TOK_SCHEMA = "shard string, doc_id long, input_ids array<int>, labels array<int>, length int"


def tok_rows(spec, seed=0):
    """spec: {shard: [length, ...]} -> token rows with distinct ids."""
    rng = random.Random(seed)
    rows, nxt = [], 0
    for shard, lens in spec.items():
        for i, n in enumerate(lens):
            ids = list(range(nxt, nxt + n))
            nxt += n
            cut = rng.randint(0, n)
            labels = [-100] * cut + ids[cut:]
            rows.append((shard, i * 3 + 1, ids, labels, n))
    return rows


def python_pack(rows, B, keep_tail=False):
    ids, labs = defaultdict(list), defaultdict(list)
    for shard, doc, i, lab, _n in sorted(rows, key=lambda r: (r[0], r[1])):
        ids[shard].extend(i)
        labs[shard].extend(lab)
    out = {}
    for shard, stream in ids.items():
        n_blocks = -(-len(stream) // B) if keep_tail else len(stream) // B
        for c in range(n_blocks):
            out[(shard, c)] = (stream[c * B:(c + 1) * B], labs[shard][c * B:(c + 1) * B])
    return out


def spark_pack(df, B, **kw):
    return {(r.shard, r.chunk): (list(r.input_ids), list(r.labels)) for r in pack_blocks(df, ["shard"], ["doc_id"], B, **kw).collect()}


def test_code_points_exact(spark):
    texts = ["aé😀b", "", "x́y", "\U0010FFFF"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r.c) for r in df.select(code_points("t").alias("c")).collect()]
    assert got == [[ord(c) for c in t] for t in texts]


def test_tokenize_masks_source_side(spark):
    df = spark.createDataFrame([(1, "s", "ab", "xyz")], "doc_id long, shard string, inputs string, outputs string")
    r = tokenize(df).first()
    assert list(r.input_ids) == [97, 98, 120, 121, 122]
    assert list(r.labels) == [-100, -100, 120, 121, 122]
    assert r.length == 5


def test_length_filter_edges(spark):
    df = spark.createDataFrame([(1, 8), (2, 9), (3, 7)], "doc_id long, length int")
    assert sorted(r.doc_id for r in length_filter(df, 8).collect()) == [1, 3]
    assert length_filter(df, None).count() == 3


def test_mask_and_width_casts(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "ids array<int>")
    r = df.select(attention_mask("ids").alias("m"), wide_ids("ids").alias("w"), narrow_ids(wide_ids("ids")).alias("n")).first()
    assert list(r.m) == [1, 1, 1] and list(r.w) == [1, 2, 3] and list(r.n) == [1, 2, 3]
    assert dict(df.select(wide_ids("ids").alias("w")).dtypes)["w"] == "array<bigint>"


@pytest.mark.parametrize(
    "spec,B",
    [
        ({"g": [3, 2]}, 8),  # group shorter than a block -> no rows
        ({"g": [4, 4, 8]}, 8),  # exact multiple
        ({"g": [30]}, 8),  # document longer than three blocks
        ({"g": [0, 5, 0, 6, 0]}, 4),  # empty documents
        ({"g": [9]}, 9),  # one-document group of exactly one block
        ({"a": [5, 7, 1], "b": [13], "c": [2]}, 4),
    ],
)
def test_pack_edges(spark, spec, B):
    rows = tok_rows(spec)
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    assert spark_pack(df, B) == python_pack(rows, B)
    assert spark_pack(df, B, keep_tail=True) == python_pack(rows, B, keep_tail=True)


def test_pack_random_property_and_repartition_invariance(spark):
    rng = random.Random(7)
    spec = {f"s{k}": [rng.randint(0, 40) for _ in range(rng.randint(1, 25))] for k in range(5)}
    spec["hot"] = [rng.randint(0, 40) for _ in range(300)]  # one group with most rows
    rows = tok_rows(spec, seed=3)
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    B = 16
    expect = python_pack(rows, B)
    assert spark_pack(df, B) == expect
    assert spark_pack(df.repartition(7), B) == expect
    # lost tokens per group = total mod B
    for shard, lens in spec.items():
        kept = sum(len(v[0]) for k, v in expect.items() if k[0] == shard)
        assert sum(lens) - kept == sum(lens) % B
    # labels differ from ids only where masked
    for ids, labs in expect.values():
        assert all(lab == i or lab == -100 for i, lab in zip(ids, labs))


def test_rewindow_equals_direct_cut(spark, tmp_path):
    rng = random.Random(11)
    rows = tok_rows({"x": [rng.randint(1, 50) for _ in range(40)], "y": [rng.randint(1, 50) for _ in range(3)]})
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    packed = pack_blocks(df, ["shard"], ["doc_id"], 16, keep_tail=True)
    re_cut = {(r.shard, r.chunk): (list(r.input_ids), list(r.labels)) for r in cut_windows(packed, 24).collect()}
    assert re_cut == python_pack(rows, 24)
    packed.write.parquet(str(tmp_path / "packed"))
    stored = spark.read.parquet(str(tmp_path / "packed"))
    regular = cut_windows(stored, 24, block_size=16)
    assert {(r.shard, r.chunk): (list(r.input_ids), list(r.labels)) for r in regular.collect()} == python_pack(rows, 24)
    plan = regular._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_flatten_tokens_positions(spark):
    rows = tok_rows({"a": [3, 0, 2], "b": [4]})
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    got = sorted((r.shard, r.pos, r.input_id, r.label) for r in flatten_tokens(df, ["shard"], ["doc_id"]).collect())
    exp = []
    for shard in ("a", "b"):
        stream = [(i, lab) for s, _d, ids, labs, _n in sorted(rows) if s == shard for i, lab in zip(ids, labs)]
        exp += [(shard, p, i, lab) for p, (i, lab) in enumerate(stream)]
    assert got == sorted(exp)


def test_chunk_estimate_overcounts(spark):
    df = spark.createDataFrame([("a", 1, 7), ("b", 1, 7)], "shard string, doc_id long, length int")
    r = chunk_estimate(df, 4).first()
    assert (r.total_tokens, r.estimated_chunks, r.exact_chunks) == (14, 3, 2)


def test_running_total_and_ordinal_with_hot_group(spark):
    rng = random.Random(5)
    data = [("hot", i, rng.randint(0, 9)) for i in range(2000)] + [(f"g{i % 7}", i, rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    got = {(r.g, r.o): r.acc for r in running_total(df, ["g"], ["o"], "v", "acc", num_parts=6).collect()}
    rn = {(r.g, r.o): r.k for r in ordinal(df, ["g"], ["o"], "k", num_parts=6).collect()}
    acc, cnt = defaultdict(int), defaultdict(int)
    for g, o, v in sorted(data, key=lambda t: (t[0], t[1])):
        assert got[(g, o)] == acc[g]
        assert rn[(g, o)] == cnt[g]
        acc[g] += v
        cnt[g] += 1


def test_pack_plan_has_no_per_token_rows(spark):
    rows = tok_rows({"a": [30, 20]})
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    plan = pack_blocks(df, ["shard"], ["doc_id"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan.lower()
    assert "Python" not in plan


def test_pack_with_mask_prefix_equals_explicit_labels(spark):
    rng = random.Random(13)
    rows = tok_rows({"a": [rng.randint(0, 30) for _ in range(40)], "b": [0, 70, 3]}, seed=9)
    with_mask = [(s, d, ids, labs, n, sum(1 for x in labs if x == -100)) for s, d, ids, labs, n in rows]
    df = spark.createDataFrame(with_mask, TOK_SCHEMA + ", n_masked int").drop("labels")
    for B, tail in ((8, False), (5, True)):
        blocks = pack_blocks(df, ["shard"], ["doc_id"], B, keep_tail=tail, mask="n_masked")
        got = {(r.shard, r.chunk): (list(r.input_ids), list(r.labels)) for r in blocks.collect()}
        assert got == python_pack(rows, B, keep_tail=tail)


def test_running_total_integer_buckets(spark, monkeypatch):
    import shardloom.operators.ordering as O

    monkeypatch.setattr(O, "BUCKET_WIDTH", 16)  # many small buckets
    rng = random.Random(21)
    keys = sorted({rng.randint(-(1 << 62), 1 << 62) for _ in range(300)} | set(range(0, 500)))
    rng.shuffle(keys)
    data = [("hot" if i % 3 else "g", k, rng.randint(0, 9)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    res = running_total(df, ["g"], ["o"], "v", "acc", inclusive=True)
    # sparse keys take the range path (bounded number of slices per group),
    # whose slices are pinned by a written table
    assert "parquet" in res._jdf.queryExecution().analyzed().toString()
    got = {(r.g, r.o): r.acc for r in res.collect()}
    acc = defaultdict(int)
    for g, o, v in sorted(data, key=lambda t: (t[0], t[1])):
        acc[g] += v
        assert got[(g, o)] == acc[g]


def test_running_total_composite_key_adaptive_slices(spark):
    rng = random.Random(31)
    data = [("hot" if i % 4 else f"g{i % 3}", f"k{rng.randint(0, 50):02d}", i, rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, a string, b long, v long")
    got = {(r.g, r.a, r.b): r.k for r in ordinal(df, ["g"], ["a", "b"], "k").collect()}
    cnt = defaultdict(int)
    for g, a, b, _v in sorted(data, key=lambda t: (t[0], t[1], t[2])):
        assert got[(g, a, b)] == cnt[g]
        cnt[g] += 1


def test_per_batch_tails(spark):
    from shardloom.operators.packing import with_batch_index

    rng = random.Random(41)
    rows = tok_rows({"a": [rng.randint(0, 20) for _ in range(23)], "b": [rng.randint(0, 20) for _ in range(5)]})
    df = spark.createDataFrame(rows, TOK_SCHEMA)
    B, per = 8, 4
    got = {
        (r.shard, r.map_batch, r.chunk): list(r.input_ids)
        for r in pack_blocks(with_batch_index(df, ["shard"], ["doc_id"], per), ["shard", "map_batch"], ["doc_id"], B).collect()
    }
    exp = {}
    for shard in ("a", "b"):
        docs = sorted((r for r in rows if r[0] == shard), key=lambda r: r[1])
        for bi in range(0, len(docs), per):
            stream = [t for r in docs[bi:bi + per] for t in r[2]]
            for c in range(len(stream) // B):
                exp[(shard, bi // per, c)] = stream[c * B:(c + 1) * B]
    assert got == exp


def test_dense_integer_keys_take_the_bucket_path(spark, monkeypatch):
    import shardloom.operators.ordering as O

    monkeypatch.setattr(O, "BUCKET_WIDTH", 16)
    data = [("hot" if i % 5 else "g", i * 3, i % 7) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    res = running_total(df, ["g"], ["o"], "v", "acc")
    plan = res._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByRange" not in plan and "parquet" not in plan
    got = {(r.g, r.o): r.acc for r in res.collect()}
    acc = defaultdict(int)
    for g, o, v in sorted(data):
        assert got[(g, o)] == acc[g]
        acc[g] += v
