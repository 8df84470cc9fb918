"""Input tables.

``read_table`` loads one of the given Parquet tables.  ``corpus_view`` and
``train_log_view`` give the driver tables the shape of the corpus rows and of
a training log (definitions in FIXTURES.md); they are plain projections and
windows over ``documents`` / ``events``, so their size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.ordering import ordinal

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus_from_documents(documents: DataFrame) -> DataFrame:
    """Corpus rows (doc_id, filing_date, ipc_label, six text sections)."""
    d = F.col("doc_id")
    text = F.col("text")
    header = F.when(d % 3 == 0, F.concat(F.lit("  <SOH h"), d.cast("string"), F.lit(" EOH>"))).otherwise(
        F.lit("")
    )
    return documents.select(
        d.alias("doc_id"),
        F.date_add(F.lit("2015-03-01").cast("date"), ((d * 7919) % 1200).cast("int")).alias("filing_date"),
        F.concat(F.upper("lang"), F.lit("0"), (d % 10).cast("string")).alias("ipc_label"),
        F.concat(F.col("source"), F.lit(" "), d.cast("string"), F.lit(" {x} ")).alias("title"),
        F.concat(header, F.substring(text, 1, 200), F.lit(" ")).alias("abstract"),
        F.substring(text, 201, 400).alias("claims"),
        F.substring(text, 601, 400).alias("background"),
        F.substring(text, 1001, 400).alias("summary"),
        F.expr("substr(text, 1401)").alias("description"),
    )


def corpus_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_from_documents(read_table(spark, sf_dir, "documents"))


def train_log_from_events(events: DataFrame, n_epochs: int = 2, n_ranks: int = 2) -> DataFrame:
    """Per-micro-step training log: (rank, epoch, step, loss, ts).

    ``rank = event_id % n_ranks``; micro-steps of a rank are its rows in
    ``(ts, event_id)`` order; an epoch is ``ceil(rows of the largest rank /
    n_epochs)`` steps long.
    """
    base = events.select(
        (F.col("event_id") % n_ranks).alias("rank"),
        "event_id",
        "ts",
        (F.col("value") / 50.0).alias("loss"),
    )
    numbered = ordinal(base, ["rank"], ["ts", "event_id"], "_k")
    # One scalar from an aggregate of (ranks) rows.
    epoch_len = (
        base.groupBy("rank").count().agg(F.ceil(F.max("count") / F.lit(n_epochs))).first()[0]
    ) or 1
    k = F.col("_k")
    return numbered.select(
        "rank",
        F.expr(f"_k div {int(epoch_len)}").cast("int").alias("epoch"),
        (k % F.lit(epoch_len)).cast("int").alias("step"),
        "loss",
        "ts",
    )


def train_log_view(spark: SparkSession, sf_dir: str, n_epochs: int = 2) -> DataFrame:
    return train_log_from_events(read_table(spark, sf_dir, "events"), n_epochs=n_epochs)


RUN_CONFIG_SCHEMA = (
    "name string, procs int, micro_batch int, accum int, seq_len int, epochs int, "
    "warmup_ratio double, log_ratio double, demo_ratio double"
)

#: Run configurations; the first row holds the demo job's sizes (1 process,
#: micro-batch 8, accumulation 16, sequence length 3,968).
RUN_CONFIGS = [
    ("demo", 1, 8, 16, 3968, 1, 0.05, 0.1, 0.2),
    ("two_proc", 2, 4, 8, 2048, 2, 0.05, 0.25, 0.5),
    ("wide", 4, 2, 4, 1024, 3, 0.1, 0.05, 0.1),
]


def run_config(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or RUN_CONFIGS, RUN_CONFIG_SCHEMA)
