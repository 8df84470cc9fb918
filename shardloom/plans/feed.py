"""Feed training from stored shards (the data-loader entry point).

shards (Parquet ``shard=`` folders or ``.npy`` parts) -> manifest -> read-time
windows of ``chunk_size`` -> workers, shuffles, sample sequence -> batches.
The result is a table a trainer reads in ``(batch_id, worker)`` order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import feed
from shardloom.operators.packing import cut_windows
from shardloom.session import materialize


@dataclass(frozen=True)
class FeedSpec:
    chunk_size: int
    batch_size: int = 8
    num_workers: int = 4
    shuffle_shards: bool = True
    shuffle_chunks: bool = False
    seed: int = 42
    epoch: int = 0
    demo_shards: int | None = None  # first N shards by name (demo mode: 2)
    world_size: int | None = None
    block_size: int | None = None  # write-time block of the stored shards, if known


def read_parquet_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards are discovered from the ``shard=`` partition folders."""
    return spark.read.parquet(path)


def _deal(manifest: DataFrame, spec: FeedSpec) -> DataFrame:
    return feed.deal_shards(
        manifest,
        num_workers=spec.num_workers,
        shuffle_shards=spec.shuffle_shards,
        seed=spec.seed,
        epoch=spec.epoch,
        demo_shards=spec.demo_shards,
    )


def _batches(chunks: DataFrame, dealt: DataFrame, spec: FeedSpec) -> DataFrame:
    """Order and counts come from the manifest, so the arrays are read once."""
    samples = feed.number_samples(
        chunks, dealt, shuffle_chunks=spec.shuffle_chunks, seed=spec.seed, epoch=spec.epoch
    )
    out = feed.delivery_order(feed.stack_batches(samples, spec.batch_size), feed.worker_batches(dealt, spec.batch_size))
    return feed.split_ranks(out, spec.world_size) if spec.world_size else out


def feed_batches(shards: DataFrame, spec: FeedSpec) -> DataFrame:
    """Stacked batches (worker, batch_id, n_samples, input_ids, labels, attention_mask, delivery[, rank])."""
    dealt = _deal(feed.shard_manifest(shards, spec.chunk_size, labels=None), spec)
    return _batches(cut_windows(shards, spec.chunk_size, block_size=spec.block_size), dealt, spec)


def deliver_batches(shards: DataFrame, spec: FeedSpec, path: str, batches_per_file: int = 64) -> DataFrame:
    """Batches written as each rank's files in delivery order (``sources.delivery``); returns their index."""
    from shardloom.sources.delivery import write_delivery

    dealt = _deal(feed.shard_manifest(shards, spec.chunk_size, labels=None), spec)
    chunks = cut_windows(shards, spec.chunk_size, block_size=spec.block_size)
    samples = feed.number_samples(chunks, dealt, shuffle_chunks=spec.shuffle_chunks, seed=spec.seed, epoch=spec.epoch)
    counts = materialize(feed.worker_batches(dealt, spec.batch_size), "worker-batches")
    return write_delivery(
        samples, counts, path, batch_size=spec.batch_size, world_size=spec.world_size or 1, per_file=batches_per_file
    )


def epoch_orders(shards: DataFrame, spec: FeedSpec, n_epochs: int) -> DataFrame:
    """Order of every epoch as a narrow table (``feed.epoch_order``); reads the
    stored block lengths only."""
    manifest = feed.first_shards(feed.shard_manifest(shards, spec.chunk_size, labels=None), spec.demo_shards)
    return feed.epoch_order(
        manifest,
        n_epochs,
        spec.batch_size,
        num_workers=spec.num_workers,
        shuffle_shards=spec.shuffle_shards,
        shuffle_chunks=spec.shuffle_chunks,
        seed=spec.seed,
    )


def feed_from_npy(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """Same batches from ``.npy`` parts; the reader already cuts the windows and
    the manifest comes from the export's, or from the files' headers."""
    from shardloom.sources.npy import npy_totals, read_npy_shards

    sizes = npy_totals(spark, path)
    dealt = _deal(sizes.withColumn("n_chunks", F.expr(f"n_tokens div {int(spec.chunk_size)}")), spec)
    opts = {"first_shards": spec.demo_shards} if spec.demo_shards else {}
    return _batches(read_npy_shards(spark, path, spec.chunk_size, **opts), dealt, spec)
