"""Merkle manifest against a plain recursive tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shardloom.llm import manifest as M
from shardloom.llm import queries

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(level):
    """Top of a list of (digest, members); every member's siblings grow as (before, after)."""
    if len(level) == 1:
        return level[0][0]
    above = []
    for i in range(0, len(level), 3):
        run = level[i : i + 3]
        for j, (_, members) in enumerate(run):
            for m in members:
                m.append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
        above.append((h(*(d for d, _ in run)), [m for _, members in run for m in members]))
    return climb(above)


def brute(rows):
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    subs = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        leaves = [(h(*map(field, r)), r) for r in groups[source]]
        leaves.sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        paths = [[] for _ in leaves]
        subs.append((climb([(d, [p]) for (d, _), p in zip(leaves, paths)]), paths))
        out += [[r, d, subs[-1][0], p] for (d, r), p in zip(leaves, paths)]
    root = climb(subs) if subs else None
    for r, d, sub, path in out:
        cut = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0 and r[4] is not None
        node = h(*map(field, [*r[:4], r[4].replace("\n", "") if cut else r[4]]))
        for before, after in path:
            node = h(before, node, after)
        yield r[0], d, sub, root, h(*(a + b for a, b in path)), node, node == root


def query(spark, rows, tmp_path, **extra):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns(extra)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in queries.op13_merkle_manifest(spark, str(tmp_path)).collect()]


@pytest.mark.parametrize(("levels", "n"), [(2, 130), (1, 41), (7, 60)])
def test_equals_brute_force(spark, monkeypatch, tmp_path, levels, n):
    """Small blocks: several rounds; a hot source, ties, repeated rows, nulls, long texts."""
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "BLOCK", M.ARITY**levels)
    rng = random.Random(levels)
    sources = ["a"] * 8 + ["b", "é", "B", "", None, "z\n"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 3, -7]), rng.choice(["x\ny", "plain", "ü\n", "", None, "\n"])) for i in range(n)]
    rows += rows[5:9] + [(3, "a", "en", 1, "other"), (3, "a", "en", 1, "another"), (None, "a", None, None, None), (None, None, None, None, "\n"), (n, "b", "en", 1, "line\n" * 40_000)]
    got = query(spark, rows, tmp_path, **{"Leaf": F.lit("x"), "a.b": F.lit(1), "pos": F.lit(2)})
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [3], [4], [9, 1], [10, 2, 2, 1], [28]])
def test_shapes(spark, monkeypatch, tmp_path, sizes):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 3)
    rows = [(100 * s + i, f"s{s}", "en", i, "a\nb") for s, n in enumerate(sizes) for i in range(n)]
    assert sorted(query(spark, rows, tmp_path)) == sorted(brute(rows))


def test_empty_table_and_clashing_names(spark, tmp_path):
    assert query(spark, [], tmp_path) == []
    docs = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    with pytest.raises(ValueError):
        M.build(docs, F.col("doc_id"), F.col("source"), [F.col("doc_id")], {"Root": F.lit(1)})


def test_levels_share_one_exchange(spark):
    """All levels of a round are windows over one exchange and one sort."""
    nodes = spark.range(3000).select(F.lit(0).alias("g"), F.col("id").alias("pos"), F.lit(3000).cast("long").alias("m"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    plan = M._levels(nodes, M.LEVELS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") >= M.LEVELS
    assert plan.count("Sort [") == 1
