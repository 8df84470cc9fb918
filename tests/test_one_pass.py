"""Tokens in one Python pass, digests from a table of id texts, batches read without a shuffle of arrays."""

from __future__ import annotations

import re

import __spark_entry__ as E
import pyarrow as pa
from pyspark.sql import functions as F

from shardloom.functions.bytelevel import byte_level_json
from shardloom.functions.tokenizer import CodePointTokenizer, JsonTokenizer, joined_sides, tokenize
from shardloom.functions.tokens import _md5s, arrow_digests, ids_digest
from shardloom.operators.streams import in_stream_order, tokens_in_place, with_place

SF_SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_in_one_pass(spark):
    texts = [(i, "ab"[i % 2], "é" * (i % 5), "𝄞x\n" * (i % 7)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, shard string, inputs string, outputs string").repartition(3)
    prompts = in_stream_order(df, ["shard"], ["doc_id"])
    for tokenizer in (CodePointTokenizer(), JsonTokenizer(byte_level_json())):
        once = tokens_in_place(prompts, tokenizer, ("doc_id", "shard"), ["shard"], ["doc_id"], 25)
        assert len(re.findall("MapInArrow", plan_of(once))) == 1
        tok = tokenize(prompts, tokenizer, keys=("doc_id", "shard")).drop("labels")
        twice = with_place(tok, ["shard"], ["doc_id"], 25)
        assert once.columns == twice.columns
        drop = ("place_part",)  # of the run
        assert sorted(once.drop(*drop).collect()) == sorted(twice.drop(*drop).collect())


def test_null_sides_stay_null():
    ids = pa.list_(pa.field("element", pa.int32(), nullable=False))
    sides = [pa.array([[1, 2], None, [], [3]], ids), pa.array([[], [4], [5], None], ids)]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3]), *sides], names=["k", "_src", "_tgt"])
    got = joined_sides(batch, ["k"]).to_pydict()
    assert got["input_ids"] == [[1, 2], None, [5], None]
    assert got["length"] == [2, None, 1, None] and got["n_masked"] == [2, None, 0, 1]


def test_prompts_are_rendered_after_the_exchange(spark):
    from shardloom.plans.build import prompt_table
    from shardloom.sources.tables import corpus_view

    plan = prompt_table(corpus_view(spark, SF_SMALL), E.SPEC, in_order=True)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "regexp_replace" in plan and "regexp_replace" not in below


def test_digests_of_arrays(spark):
    rows = [([1, -100, 1114111], [[1, 2], [-5]]), ([], []), (None, None), ([7, None], [[], None, [1 << 31]]), ([-200], [[]])]
    df = spark.createDataFrame(rows, "a array<int>, b array<array<bigint>>").coalesce(1)
    one, many = arrow_digests(spark)
    nested = F.md5(F.array_join(F.transform("b", lambda x: ids_digest(x)), ","))
    for r in df.select(ids_digest("a").alias("x"), one("a").alias("y"), nested.alias("u"), many("b").alias("v")).collect():
        assert (r.x, r.u) == (r.y, r.v)
    lists = pa.array([[9], None, [0, -128, 1114111], [], [10, 11]], pa.list_(pa.int32()))
    assert _md5s(lists.slice(2)) == _md5s(lists)[2:]


def test_delivered_arrays_are_not_shuffled_again(spark):
    plan = plan_of(E.q_delivery_files(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and not re.search(r"hashpartitioning\(rank#\d+, file#", plan)
