"""Corpus statistics and the epoch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shard_token_totals(tok: DataFrame, length: str = "length") -> DataFrame:
    """G1: tokens per shard after the length filter, with a readable
    description (thousands separators and the window dates)."""
    per = tok.groupBy("shard").agg(F.sum(length).cast("long").alias("total_tokens"))
    parts = F.split(F.col("shard"), "_")
    per = per.select(
        "shard",
        parts.getItem(1).alias("window_start"),
        parts.getItem(2).alias("window_end"),
        "total_tokens",
        F.format_number(F.col("total_tokens"), 0).alias("total_tokens_fmt"),
    )
    # The wording of the description.
    return per.withColumn(
        "description",
        F.concat(
            F.lit("Total tokens "), F.col("total_tokens_fmt"),
            F.lit("\nStart date "), F.col("window_start"),
            F.lit(", end date "), F.col("window_end"),
        ),
    )


def corpus_summary(manifest: DataFrame, chunk_size: int, demo_mode: bool = False) -> DataFrame:
    """One row - shards, tokens per shard (name order), total tokens,
    chunks as the reader sizes itself (``total div chunk``), chunk size."""
    per = F.sort_array(F.collect_list(F.struct("shard", "n_tokens")))
    return manifest.agg(
        F.count("*").cast("long").alias("n_shards"),
        F.concat_ws(",", F.transform(per, lambda s: s["n_tokens"].cast("string"))).alias("tokens_per_shard"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("total_tokens"),
    ).select(
        "n_shards",
        "tokens_per_shard",
        "total_tokens",
        F.expr(f"total_tokens div {int(chunk_size)}").alias("n_chunks"),
        F.lit(int(chunk_size)).cast("long").alias("chunk_size"),
        F.lit(bool(demo_mode)).alias("demo_mode"),
    )


def epoch_plan(summary: DataFrame | int, configs: DataFrame) -> DataFrame:
    """One plan row per run configuration.

    ``summary`` is the ``corpus_summary`` row, read as a scalar subquery of the same
    plan (its ``total_tokens``; no rows: 0), or the corpus total itself.  The
    loader length is ``ceil(chunks / micro_batch)`` with ``chunks = total div
    seq_len``; after the per-process split it is ``ceil(len / procs)``.
    ``samples_per_epoch`` keeps the reference formula (loader length before
    the split times procs), ``samples_per_epoch_split`` uses the split length.
    """
    total = F.lit(int(summary)) if isinstance(summary, int) else F.coalesce(summary.select("total_tokens").scalar(), F.lit(0))
    plan = configs.select("*", total.cast("long").alias("_sl_total")).withColumn("est_chunks", F.expr("_sl_total div seq_len"))
    plan = plan.withColumn("loader_len", F.ceil(F.col("est_chunks") / F.col("micro_batch")).cast("long"))
    plan = plan.withColumn("loader_len_split", F.ceil(F.col("loader_len") / F.col("procs")).cast("long"))
    return plan.select(
        "name",
        "est_chunks",
        "loader_len",
        "loader_len_split",
        (F.col("procs") * F.col("micro_batch") * F.col("accum")).cast("long").alias("samples_per_step"),
        (F.col("procs") * F.col("micro_batch") * F.col("accum") * F.col("seq_len")).cast("long").alias("tokens_per_step"),
        (F.col("seq_len") * F.col("procs") * F.col("micro_batch")).cast("long").alias("tokens_per_micro_step"),
        (F.col("loader_len") * F.col("procs") * F.col("micro_batch")).cast("long").alias("samples_per_epoch"),
        (F.col("loader_len_split") * F.col("procs") * F.col("micro_batch")).cast("long").alias("samples_per_epoch_split"),
        (F.col("loader_len") * F.col("procs") * F.col("micro_batch") * F.col("seq_len")).cast("long").alias("tokens_per_epoch"),
        # denominator of the progress lines: micro-step tokens x split loader length
        (F.col("seq_len") * F.col("procs") * F.col("micro_batch") * F.col("loader_len_split")).cast("long").alias("epoch_tokens"),
        F.expr("loader_len_split div accum").cast("long").alias("opt_steps_per_epoch"),
        (F.expr("loader_len_split div accum") * F.col("epochs")).cast("long").alias("total_opt_steps"),
        F.floor(F.expr("(loader_len_split div accum) * epochs") * F.col("warmup_ratio")).cast("long").alias("warmup_steps"),
        F.floor(F.expr("loader_len_split div accum") * F.col("log_ratio")).cast("long").alias("log_interval"),
        F.floor(F.expr("loader_len_split div accum") * F.col("demo_ratio")).cast("long").alias("demo_steps"),
    )
