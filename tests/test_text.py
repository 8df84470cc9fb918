"""Cleaning, null policy, template rendering, chat wrapping."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shardloom.functions import templates as T
from shardloom.functions.text import WHITESPACE, clean_section, section_text, with_patent_text

EDGE = [
    "  <SOH a EOH> body\n",
    "<SOH a\rb EOH> z",
    "<SOH a\nb EOH> z",
    " \x1c inner text \x1c ",
    "<SOH a EOH><SOH b EOH>x",
    "x<SOHxEOH>",
    "<SOHEOH>EOH>q",
    "<SOH EOH>w",
    "",
    " <SOH \u0085 EOH>tail　",
    "<SOH a b EOH>rest",
]


def python_clean(s: str) -> str:
    return re.compile(r"^<SOH.+?EOH>").sub("", s.strip())


def test_whitespace_set_is_pythons():
    assert len(WHITESPACE) == 29
    assert all(c.isspace() for c in WHITESPACE)


def test_clean_matches_python_on_edge_strings(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(EDGE)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", clean_section("s").alias("c")).collect()}
    for i, s in enumerate(EDGE):
        assert got[i] == python_clean(s), (i, s)


def test_named_edge_results(spark):
    df = spark.createDataFrame([(s,) for s in ["<SOHEOH>EOH>q", "<SOH EOH>w", "<SOH a\rb EOH> z", "<SOH a\nb EOH> z"]], "s string")
    got = [r.c for r in df.select(clean_section("s").alias("c")).collect()]
    assert got == ["q", "w", " z", "<SOH a\nb EOH> z"]


def _row(**kw):
    base = dict(doc_id=1, ipc_label="EN01", title="t", abstract="a", claims="c", background="b", summary="s", description="d")
    base.update(kw)
    return base


def test_section_text_layout(spark):
    df = spark.createDataFrame([_row(title=" <SOH x EOH>T ")])
    text = df.select(section_text().alias("t")).first().t
    assert text == "[TITLE]\nT\n[ABSTRACT]\na\n[CLAIMS]\nc\n[BACKGROUND]\nb\n[SUMMARY]\ns\n[DESCRIPTION]\nd"


def test_null_policy(spark):
    schema = "doc_id long, ipc_label string, title string, abstract string, claims string, background string, summary string, description string"
    df = spark.createDataFrame([(1, "EN01", "t", "a", None, "b", "s", "d")], schema)
    out = with_patent_text(df, on_null="empty").first().text
    assert "[CLAIMS]\n\n[BACKGROUND]" in out
    with pytest.raises(Exception, match="null value in text column claims"):
        with_patent_text(df, on_null="error").collect()
    with pytest.raises(ValueError):
        with_patent_text(df, on_null="skip")


def test_render_keeps_value_braces_literal(spark):
    df = spark.createDataFrame([("EN01", "A {title} with {}")], "ipc_label string, title string")
    tpl = "Code {ipc_code} / {title} / {{literal}}"
    got = df.select(T.render(tpl, {"ipc_code": "ipc_label", "title": "title"}).alias("r")).first().r
    assert got == tpl.format(ipc_code="EN01", title="A {title} with {}")


def test_render_literal_json_template(spark):
    text = 'Reply as {"a": [1, 2]}'
    df = spark.range(1)
    assert df.select(T.render(text, {}, literal=True).alias("r")).first().r == text
    with pytest.raises((KeyError, ValueError)):
        T.render(text, {})


def test_chat_prompts_shape(spark):
    df = spark.createDataFrame([(7, "s1", "FR07", "Tit {x}", "BODY")], "doc_id long, shard string, ipc_label string, title string, text string")
    r = T.chat_prompts(df, "SYS", "U {ipc_code} {title}").first()
    assert r.inputs == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nSYS<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nU FR07 Tit {x}<|eot_id|>"
    )
    assert r.outputs == "<|start_header_id|>assistant<|end_header_id|>\n\nBODY<|eot_id|><|end_of_text|>"
    q = T.qa_prompts(df, '{"json": true}', "P: {patent_text}").first()
    assert '{"json": true}' in q.inputs and q.inputs.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")


def test_text_expressions_stay_in_jvm(spark):
    cols = [F.concat(F.lit(" <SOH h EOH>"), F.col("id").cast("string")).alias(c) for c in
            ("title", "abstract", "claims", "background", "summary", "description")]
    df = spark.range(10).select(*cols)
    plan = df.select(section_text().alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.startswith("*(")
