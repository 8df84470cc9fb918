"""

Every query reads the driver's tables (``documents`` or ``events``) whole and
runs the library's operators on them; ``oracle_sql`` gives the same result in
DuckDB SQL written independently over the same tables.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import params as P  # noqa: E402
from shardloom.functions.templates import qa_prompts, render  # noqa: E402
from shardloom.functions.text import SECTION_COLUMNS, clean_sections, section_text  # noqa: E402
from shardloom.functions.tokenizer import length_report  # noqa: E402
from shardloom.functions.tokens import arrow_digests, ids_digest  # noqa: E402
from shardloom.operators import feed, logfold, packing, stats, trainlog  # noqa: E402
from shardloom.operators.limits import sample_limit  # noqa: E402
from shardloom.operators.ordering import broadcast_if_small  # noqa: E402
from shardloom.operators.windows import (  # noqa: E402
    assign_windows,
    date_windows,
    filter_label_prefix,
    scan_window,
    split_by_dates,
)
from shardloom.plans.build import BuildSpec, materialized_tokens, packed_shards, prompt_table, spread, token_table  # noqa: E402
from shardloom.plans.feed import FeedSpec, deliver_batches  # noqa: E402
from shardloom.session import drop_stored, ensure_checkpoint_dir, materialize, scratch_path  # noqa: E402
from shardloom.sources.delivery import read_rank  # noqa: E402
from shardloom.sources.tables import corpus_view, read_table, run_config, train_log_view  # noqa: E402

SPEC = BuildSpec(
    system_prompt=P.SYSTEM_PROMPT,
    user_template=P.USER_TEMPLATE,
    assistant_template=P.ASSISTANT_TEMPLATE,
    start=P.START,
    end=P.END,
    step_months=P.STEP,
    max_len=P.MAX_LEN,
    block_size=P.BLOCK,
)


# ---------------------------------------------------------------- helpers
def _corpus(spark, sf):
    ensure_checkpoint_dir(spark)
    return corpus_view(spark, sf)


def _windowed(spark, sf):
    return assign_windows(_corpus(spark, sf), "filing_date", P.START, P.END, P.STEP)


def _spec(spark, **changes) -> BuildSpec:
    """SPEC for this session: the driver files hold one row group each (one
    scan task), so tokenising is spread over the session's cores."""
    return BuildSpec(**{**SPEC.__dict__, "spread_partitions": spark.sparkContext.defaultParallelism, **changes})


def _tokens(spark, sf, max_len="spec", tokenizer=None):
    spec = _spec(spark) if max_len == "spec" else _spec(spark, max_len=max_len)
    return materialized_tokens(_corpus(spark, sf), spec, tokenizer)


def _packed(spark, sf):
    """Write-time blocks (tail kept), written once by ``packed_shards``."""
    return packed_shards(_tokens(spark, sf), SPEC, keep_tail=True)


def _chunks(spark, sf):
    """Read-time windows of CHUNK tokens cut from the packed shards."""
    return packing.cut_windows(_packed(spark, sf), P.CHUNK, block_size=P.BLOCK)


def _manifest(spark, sf, packed=None):
    return feed.shard_manifest(packed if packed is not None else _packed(spark, sf), P.CHUNK)


def _samples(spark, sf):
    packed = _packed(spark, sf)
    chunks = packing.cut_windows(packed, P.CHUNK, block_size=P.BLOCK)
    man = feed.shard_manifest(packed, P.CHUNK, labels=None)
    return feed.feed_samples(
        chunks, man, num_workers=P.WORKERS, shuffle_shards=True, shuffle_chunks=True, seed=P.SEED, epoch=P.EPOCH
    )


def _digest_blocks(blocks: DataFrame) -> DataFrame:
    digest, _ = arrow_digests(blocks.sparkSession)
    return blocks.select(
        "shard",
        "chunk",
        F.size("input_ids").cast("long").alias("n_tokens"),
        digest("input_ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
    )


def _log(spark, sf):
    ensure_checkpoint_dir(spark)
    return materialize(train_log_view(spark, sf, n_epochs=P.LOG_EPOCHS), "train_log")


def _windows(spark, sf):
    return trainlog.loss_windows(_log(spark, sf), P.ACCUM, P.UPDATE_FREQ, P.TOKENS_PER_MICRO_STEP)


# ---------------------------------------------------------------- queries
def q_date_windows(spark, sf):
    wins = date_windows(spark, P.START, P.END, P.STEP)
    counts = _windowed(spark, sf).groupBy("shard").agg(F.count("*").alias("n"))
    j = wins.join(counts, "shard", "left")
    return j.select(
        "window_idx",
        F.col("window_start").cast("string").alias("window_start"),
        F.col("window_end").cast("string").alias("window_end"),
        "shard",
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_docs"),
    )


def q_window_assign(spark, sf):
    return _windowed(spark, sf).select("doc_id", F.col("filing_date").cast("string").alias("filing_date"), "shard")


def q_ipc_filter(spark, sf):
    return filter_label_prefix(_corpus(spark, sf), P.LABEL_PREFIX).select("doc_id", "ipc_label")


def q_scan_window(spark, sf):
    """Both date bounds reach the Parquet scan."""
    rows = scan_window(read_table(spark, sf, "orders"), "o_orderdate", *P.SCAN)
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_date"))


def q_split_train_val(spark, sf):
    return split_by_dates(_corpus(spark, sf), "filing_date", P.TRAIN, P.VAL).select("doc_id", "split")


def q_clean_sections(spark, sf):
    return clean_sections(_corpus(spark, sf)).select("doc_id", *SECTION_COLUMNS)


def q_patent_text(spark, sf):
    return _corpus(spark, sf).select("doc_id", section_text().alias("text"))


def q_user_prompt(spark, sf):
    return _corpus(spark, sf).select(
        "doc_id", render(P.USER_TEMPLATE, {"ipc_code": "ipc_label", "title": "title"}).alias("user_prompt")
    )


def q_null_label(spark, sf):
    """P5 with null labels: the document stays, the field reads ``None``."""
    holed = _corpus(spark, sf).withColumn("ipc_label", F.when(F.col("doc_id") % 9 != 0, F.col("ipc_label")))
    return holed.select(
        "doc_id", render(P.USER_TEMPLATE, {"ipc_code": "ipc_label", "title": "title"}).alias("user_prompt")
    )


def q_chat_prompts(spark, sf):
    return prompt_table(_corpus(spark, sf), SPEC).select("doc_id", "shard", "inputs", "outputs")


def q_qa_prompts(spark, sf):
    texts = _corpus(spark, sf).select("doc_id", section_text().alias("text"))
    return qa_prompts(texts, P.QA_SYSTEM_TEXT, P.QA_USER_TEMPLATE)


def q_null_policy(spark, sf):
    holed = _corpus(spark, sf).withColumn(
        "claims", F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("claims"))
    )
    return holed.select("doc_id", section_text(on_null="empty").alias("text"))


def q_sample_limit(spark, sf):
    return sample_limit(_windowed(spark, sf), P.N_SAMPLES, ["doc_id"], ["shard"]).select("shard", "doc_id")


def q_tokenize_cp(spark, sf):
    tok = token_table(spread(_corpus(spark, sf), spark.sparkContext.defaultParallelism), SPEC, max_len=None)
    return tok.select(
        "doc_id",
        "shard",
        F.col("length").cast("long").alias("length"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("n_src"),
        ids_digest("input_ids").alias("ids_md5"),
    )


def q_tokenize_bpe(spark, sf):
    """A1 through the Python tokenizer path (mapInPandas, broadcast JSON)."""
    from shardloom.functions.bytelevel import byte_level_json
    from shardloom.functions.tokenizer import JsonTokenizer

    tok = _tokens(spark, sf, tokenizer=JsonTokenizer(byte_level_json()))
    return tok.select(
        "doc_id",
        "shard",
        F.col("length").cast("long").alias("length"),
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("n_src"),
        ids_digest("input_ids").alias("ids_md5"),
        ids_digest("labels").alias("labels_md5"),
    )


def q_label_mask(spark, sf):
    tok = _tokens(spark, sf)
    return tok.select(
        "doc_id",
        "shard",
        F.size(F.filter("labels", lambda x: x == -100)).cast("long").alias("n_masked"),
        ids_digest("labels").alias("labels_md5"),
    )


def q_length_filter(spark, sf):
    return length_report(_tokens(spark, sf, max_len=None), P.LENGTH_CAP)


def q_shard_tokens(spark, sf):
    return stats.shard_token_totals(_tokens(spark, sf))


def q_flatten_tokens(spark, sf):
    flat = packing.flatten_tokens(_tokens(spark, sf), ["shard"], ["doc_id"])
    return flat.select("shard", "pos", "doc_id", "input_id", "label")


def q_pack_blocks(spark, sf):
    return _digest_blocks(packing.pack_blocks(_tokens(spark, sf), ["shard"], ["doc_id"], P.BLOCK, mask="n_masked"))


def q_shard_chunks(spark, sf):
    return _digest_blocks(packing.pack_blocks(_tokens(spark, sf), ["shard"], ["doc_id"], P.CHUNK, mask="n_masked"))


def q_rewindow(spark, sf):
    return _digest_blocks(_chunks(spark, sf))


def _npy_export(spark, sf):
    """Packed shards exported as flat ``.npy`` parts in the shared folder; the stored
    tokens and blocks go as soon as the next form is there."""
    from shardloom.sources.npy import write_npy_shards

    path, tokens = scratch_path(spark, "npy"), _tokens(spark, sf)
    packed = packed_shards(tokens, SPEC, keep_tail=True)
    drop_stored(tokens, keep=packed)
    write_npy_shards(packed, path, in_order="masked" in packed.columns)
    drop_stored(packed)
    return path


def q_npy_read(spark, sf):
    """The array-shard reader cuts CHUNK windows per shard."""
    from shardloom.sources.npy import read_npy_shards

    return _digest_blocks(read_npy_shards(spark, _npy_export(spark, sf), P.CHUNK))


def q_npy_manifest(spark, sf):
    """S4 + S5 on the array files: token counts per shard from the part index."""
    from shardloom.sources.npy import npy_totals

    return npy_totals(spark, _npy_export(spark, sf))


def q_parquet_shards(spark, sf):
    """S7 + S4: shards written as Parquet partitioned by shard, discovered
    from the folders and summarised from the stored per-block counts."""
    from shardloom.plans.build import build_shards

    path = scratch_path(spark, "parquet-shards")
    stored = build_shards(_corpus(spark, sf), _spec(spark), path)
    man = feed.shard_manifest(stored.select("shard", "n_tokens"), P.CHUNK, labels=None)
    lab = feed.shard_manifest(stored.select("shard", F.col("labels").alias("input_ids")), labels=None)
    return man.join(lab.withColumnRenamed("n_tokens", "n_labels"), "shard").select("shard", "n_tokens", "n_labels", "n_chunks")


def q_split_shards(spark, sf):
    """Train and validation shards, and what was written."""
    from shardloom.plans.build import build_splits, write_report

    path = scratch_path(spark, "split-shards")
    stored = build_splits(_corpus(spark, sf), _spec(spark), {"train": P.TRAIN, "val": P.VAL}, path)
    train, val = (write_report(stored[s]).select(F.lit(s).alias("split"), "shard", "n_blocks", "n_tokens") for s in ("train", "val"))
    return train.unionByName(val)


def q_manifest(spark, sf):
    return _manifest(spark, sf)


def q_corpus_summary(spark, sf):
    return stats.corpus_summary(_manifest(spark, sf), P.CHUNK)


def q_chunk_estimate(spark, sf):
    return packing.chunk_estimate(_tokens(spark, sf), P.CHUNK)


def q_first_shards(spark, sf):
    return feed.first_shards(_manifest(spark, sf), P.DEMO_SHARDS).select("shard", "n_tokens")


def q_worker_stripe(spark, sf):
    return feed.stripe_workers(_manifest(spark, sf), P.WORKERS).select("shard", "worker")


def q_shard_shuffle(spark, sf):
    man = feed.stripe_workers(_manifest(spark, sf), P.WORKERS)
    return feed.order_shards(man, shuffle=True, seed=P.SEED, epoch=P.EPOCH).select("shard", "worker", "shard_rank")


def q_chunk_shuffle(spark, sf):
    keys = materialize(_chunks(spark, sf).select("shard", "chunk"), "chunk-keys")  # the windows are cut once
    ranked = feed.order_chunks(keys, shuffle=True, seed=P.SEED, epoch=P.EPOCH)
    return ranked.select("shard", "chunk", "chunk_rank")


def q_sample_sequence(spark, sf):
    return _samples(spark, sf).select("worker", "seq", "shard", "chunk")


def q_epoch_order(spark, sf):
    """W4-W8 of several epochs from the manifest alone."""
    from shardloom.plans.feed import FeedSpec, epoch_orders

    spec = FeedSpec(P.CHUNK, P.BATCH, P.WORKERS, shuffle_chunks=True, seed=P.SEED)
    return epoch_orders(_packed(spark, sf), spec, P.FEED_EPOCHS)


def _packed_manifest(spark, sf):
    return feed.shard_manifest(_packed(spark, sf).select("shard", "n_tokens"), P.CHUNK, labels=None)


def q_keyed_order(spark, sf):
    """W6-W8 by a keyed permutation: each sample's chunk from its place alone."""
    return feed.keyed_order(_packed_manifest(spark, sf), P.FEED_EPOCHS, P.BATCH, num_workers=P.WORKERS, seed=P.SEED)


def q_keyed_resume(spark, sf):
    """The same from a batch in the middle of the second epoch on."""
    return feed.keyed_order(
        _packed_manifest(spark, sf), 2, P.BATCH, num_workers=P.WORKERS, seed=P.SEED, first_epoch=1, first_batch=P.RESUME_BATCH
    )


def q_batches(spark, sf):
    b = feed.stack_batches(_samples(spark, sf), P.BATCH)
    digest = {c: _batch_digest(spark, c) for c in ("input_ids", "labels")}
    ones = F.size(F.filter(F.flatten("attention_mask"), lambda x: x == 1))
    return b.select(
        "worker", "batch_id", "n_samples", digest["input_ids"].alias("batch_md5"), digest["labels"].alias("labels_md5"),
        ones.cast("long").alias("n_attended"), F.size(F.flatten("attention_mask")).cast("long").alias("n_mask"),
        F.concat_ws(" ", *[F.typeof(c) for c in ("input_ids", "labels", "attention_mask")]).alias("types"),
    )


def _delivered(spark, sf):
    """Batches in delivery order: counts and keys come from the dealt manifest."""
    man = _packed_manifest(spark, sf)
    dealt = feed.deal_shards(man, num_workers=P.WORKERS, seed=P.SEED, epoch=P.EPOCH)
    counts = materialize(feed.worker_batches(dealt, P.BATCH), "worker-batches")
    return feed.delivery_order(feed.batch_keys(counts), counts)


def q_delivery_order(spark, sf):
    return _delivered(spark, sf)


def q_rank_split(spark, sf):
    return feed.split_ranks(_delivered(spark, sf), P.WORLD).select("worker", "batch_id", "rank")


def _delivery(spark, sf) -> str:
    spec = FeedSpec(
        P.CHUNK, P.BATCH, P.WORKERS, shuffle_chunks=True, seed=P.SEED, epoch=P.EPOCH, world_size=P.WORLD, block_size=P.BLOCK
    )
    path = scratch_path(spark, "delivery")
    deliver_batches(_packed(spark, sf), spec, path, P.FILE_BATCHES)
    return path


def _batch_digest(spark, column: str):
    return arrow_digests(spark)[1](column)


def q_delivery_files(spark, sf):
    """Each rank's batches as its files give them: files in name order, rows as they lie in them."""
    rows = spark.read.parquet(f"{_delivery(spark, sf)}/batches").select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    earlier = Window.partitionBy("rank").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = materialize(rows.groupBy("rank", "file").agg(F.count("*").alias("n")), "delivery-heads")
    heads = files.select("rank", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("head"))
    return rows.join(broadcast_if_small(heads), ["rank", "file"]).select(
        "rank", (F.col("head") + F.col("row")).cast("long").alias("place"), "worker", "batch_id", "n_samples",
        _batch_digest(spark, "input_ids").alias("batch_md5"), _batch_digest(spark, "labels").alias("labels_md5"),
    )


def q_delivery_resume(spark, sf):
    """Every rank's stream from slot RESUME_SLOT on."""
    path = _delivery(spark, sf)
    streams = [read_rank(spark, path, r, P.RESUME_SLOT) for r in range(P.WORLD)]
    return reduce(DataFrame.unionByName, streams).select(
        "rank", "slot", "delivery", "worker", "batch_id", _batch_digest(spark, "input_ids").alias("batch_md5")
    )


def q_pair_check(spark, sf):
    """J1 on shards with holes: some have no ids, some no labels, some lack the
    labels of their first block."""
    packed, month = _packed(spark, sf), F.substring("shard", 12, 2)
    ids_man = feed.shard_manifest(packed.where(month != "07").select("shard", "input_ids"), labels=None)
    held = packed.where((month != "11") & ~((month == "03") & (F.col("chunk") == 0)))
    lab_man = feed.shard_manifest(held.select("shard", F.col("labels").alias("input_ids")), labels=None)
    return feed.pair_shards(ids_man, lab_man).select("shard", "n_ids", "n_labels", "status")


def q_length_check(spark, sf):
    """J2 on shards of which some lack the last 5 labels of their first block."""
    packed = _packed(spark, sf)
    short = (F.substring("shard", 12, 2) == "03") & (F.col("chunk") == 0)
    cut = F.when(short, F.slice("labels", 1, F.size("labels") - 5)).otherwise(F.col("labels"))
    return feed.check_lengths(_manifest(spark, sf, packed.withColumn("labels", cut)))


def q_epoch_plan(spark, sf):
    per_shard = _tokens(spark, sf).groupBy("shard").agg(F.sum("length").cast("long").alias("n_tokens"))
    return stats.epoch_plan(stats.corpus_summary(per_shard, P.CHUNK), run_config(spark, P.RUN_CONFIGS))


def q_step_windows(spark, sf):
    s = trainlog.assign_steps(_log(spark, sf), P.ACCUM, P.UPDATE_FREQ)
    return s.select("rank", "epoch", "step", "opt_step", "is_sync", "log_window")


def _window_columns(windows):
    return windows.select(
        "log_window", "epoch", "end_step", "global_step", F.col("loss_sum").cast("string").alias("loss_sum"),
        "micro_steps", "n_ranks", "spans_epoch",
    )


def q_loss_windows(spark, sf):
    return _window_columns(_windows(spark, sf))


def q_loss_windows_folded(spark, sf):
    """The windows from three slices of the log, folded in as they arrive."""
    log, path = _log(spark, sf), scratch_path(spark, "folded-log")
    rule = logfold.FoldRule(P.ACCUM, P.UPDATE_FREQ, P.TOKENS_PER_MICRO_STEP, n_ranks=P.PROCS)
    cuts = [None, *P.LOG_CUTS, None]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        part = log if lo is None else log.where(F.col("ts") >= F.lit(lo).cast("timestamp"))
        part = part if hi is None else part.where(F.col("ts") < F.lit(hi).cast("timestamp"))
        logfold.fold(part, path, rule, finish=hi is None)
    return _window_columns(logfold.folded_windows(spark, path))


def q_perplexity(spark, sf):
    return _windows(spark, sf).select("log_window", F.round("perplexity", 6).alias("perplexity"))


def q_throughput(spark, sf):
    return _windows(spark, sf).select(
        "log_window", F.round("elapsed_sec", 6).alias("elapsed_sec"), F.round("tokens_per_sec", 6).alias("tokens_per_sec")
    )


def q_stream_loss_windows(spark, sf):
    """G5/G9 online: the log arrives as a file stream; windows are emitted
    by a stateful operator as soon as they are full."""
    from shardloom.streaming.loss_windows import run_to_table, stream_loss_windows

    log = _log(spark, sf)
    src = scratch_path(spark, "log-stream")
    log.repartition(6).write.parquet(src)
    dims = log.agg((F.max("step") + 1).alias("e"), (F.max("epoch") + 1).alias("n"), F.countDistinct("rank").alias("r")).first()
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(src)
    out = stream_loss_windows(
        stream, steps_per_epoch=int(dims.e), n_epochs=int(dims.n), accum=P.ACCUM, update_freq=P.UPDATE_FREQ, n_ranks=int(dims.r)
    )
    res = run_to_table(out, scratch_path(spark, "log-windows"), scratch_path(spark, "log-windows-ckpt"))
    return res.select(
        "log_window", "epoch", "end_step", "global_step", "loss_sum", "micro_steps", "n_ranks", "spans_epoch"
    )


def q_progress(spark, sf):
    log = _log(spark, sf)
    loader_len = log.agg(F.max("step") + 1).first()[0]
    return trainlog.progress_rows(log, P.TOKENS_PER_MICRO_STEP, int(loader_len), accum=P.ACCUM)


def q_demo_cut(spark, sf):
    return trainlog.demo_cut(_log(spark, sf), P.ACCUM, P.DEMO_STEPS).select("rank", "epoch", "step", "opt_step")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: corpus -> prompts -> tokens -> packed blocks, at sf0.001."""
    return q_pack_blocks(spark, "/root/testdata/sf0.001")


def _llm():
    """The module of the training-data operators, or None where that
    subpackage (or the pipeline built on it) is not there.  An error inside
    it is not swallowed."""
    if importlib.util.find_spec("shardloom.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    from shardloom.llm import queries as module

    return module


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    module = _llm()
    return {**_QUERIES, **(module.queries() if module else {})}


def oracle_sql() -> dict[str, str]:
    from checks.oracle import queries_sql

    sql = queries_sql()
    module = _llm()
    return {**{k: v for k, v in sql.items() if k in _QUERIES}, **(module.SQL if module else {})}
