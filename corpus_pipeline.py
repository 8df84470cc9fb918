"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import bpe, decontaminate, linededup, minhash, quality
from shardloom.llm.common import fold, read, stage
from shardloom.llm.queries import QUALITY_CUT, tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``QUALITY_CUT``; learned from
    the labels of documents outside the held-out fold (crc32 of the id mod 5)."""
    cols = docs.columns
    model = quality.fit(docs, read(spark, sf_dir, "labels"), use=fold(F.col("doc_id"), 5) != 0)
    scored = quality.score(docs, model, out="__ll_score")
    return scored.where(F.col("__ll_score") >= QUALITY_CUT).select(*cols)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines taken out; documents left with no line go.
    ``n_chars`` follows the text."""
    cols = docs.columns
    out = linededup.deduplicate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*cols) if "n_chars" in cols else out


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    ranks, pattern = tokenizer()
    tokens = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), ranks, pattern, decoded="decoded")
    whole = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")).cast("binary"))
    return tokens.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), whole.alias("round_trip")
    )


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

#: No stage's method but the fourth's can be written in SQL; see tests/llm/test_dedup_operators.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
