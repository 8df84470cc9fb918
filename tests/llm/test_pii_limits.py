"""Odd texts and column names: no crash, linear time, whole context words."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shardloom.llm import bpe, langid, pii, quality
from shardloom.llm.queries import tokenizer


def plain_ips(text):
    for m in re.finditer(pii.IP, text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield m.span()


def test_leading_zeros_beyond_the_digit_limit():
    assert [s[:3] for s in pii.find_spans("0" * 5000 + ".1.1.1")] == [("ip", 0, 5006)]
    assert pii.find_spans("9" * 5000 + ".1.1.1") == []


def test_ips_equal_the_contract_pattern():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(["1", "25", "0", ".", ".", "..", " ", "x", "300", "1.2.3.4"], k=rng.randrange(1, 25)))
        assert [s[1:3] for s in pii.find_spans(text) if s[0] == "ip"] == list(plain_ips(text)), text


@pytest.mark.parametrize("unit", ["7", "7 ", "7.", "+7", "a@", "a.@b", "A", "12-", "DE89 ", "@", "+7 ", "1.1.1", "a.b-"])
def test_long_texts_are_scanned_in_linear_time(unit):
    began = time.process_time()
    pii.find_spans(unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 5


def test_context_words_are_whole():
    number = "123-45-6789"
    assert [s[0] for s in pii.find_spans(f"his ssn {number}")] == ["national_id"]
    assert pii.find_spans(f"socialist securityguard {number}") == []
    near, far = (pii.find_spans(f"{w} 10.0.0.1")[0][3] for w in ("ip", "recipe"))
    assert near > far


def test_any_column_names(spark):
    docs = spark.createDataFrame([(1, "mail a@b.de", "x"), (2, None, None)], "doc_id long, text string, `a.b` string")
    docs = docs.withColumns({"Score": F.lit("mine"), "Spans": F.lit(1), "IDS": F.lit(2)})
    ranks, pattern = tokenizer()
    made = {
        "spans": pii.find_pii(docs),
        "score": quality.score(docs, quality.QualityModel(b"", b"", [], 0.5)),
        "lang_pred": langid.identify(docs, langid.KernelModel([], [])),
        "ids": bpe.decode_documents(bpe.encode_documents(docs, ranks, pattern), ranks),
    }
    for name, out in made.items():
        low = [c.lower() for c in out.columns]
        assert len(set(low)) == len(low) and name in out.columns and "a.b" in out.columns
        rows = sorted(out.collect())
        assert [r["a.b"] for r in rows] == ["x", None] and rows[0]["text"] == "mail a@b.de"


def test_quality_fit_does_not_depend_on_row_order(spark):
    rows = [(i, ("good prose of many kinds " if i % 2 else "buy now !!! $$$ ") * (3 + i % 5)) for i in range(40)]
    rows += [(i, t + f"another text {i}") for i, t in rows[:10]]
    labels = [(i, i % 2) for i in range(40)] + [(3, 1), (4, 1)]
    models = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        models.append((model.good, model.bad, model.weights, model.prior))
    assert models[0] == models[1]
