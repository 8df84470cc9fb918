"""From packed shards to training batches.

The shard manifest has one row per shard (each shard is ~1 B tokens, so it is
small by construction); ordering and dealing happen on it and are joined back
to the chunk rows as a broadcast after a size check.  Per-chunk work stays
keyed by ``(shard, chunk)``: no worker-wide sort, no per-token rows.

Shuffles are hash orders: ``md5(seed|epoch|shard[|chunk])``.  They are
deterministic and epoch-aware (pass ``epoch=0`` everywhere to get the same
order each epoch); they are not the permutation of a Mersenne Twister.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions.tokens import attention_mask, labels_from_runs, wide_ids
from shardloom.operators.ordering import broadcast_if_small, ordinal
from shardloom.operators.permutation import at_place
from shardloom.session import materialize

#: Chunk keys generated from one manifest row at a time; a hot shard has many such slices.
KEY_SLICE = 1 << 16
#: Ranks of so many chunks of a shard are looked up as one array (32 KB), if there are at most so many such arrays.
RANK_SLICE, RANK_SLICES = 1 << 12, 1 << 13


def shard_manifest(
    shards: DataFrame,
    chunk_size: int | None = None,
    ids: str = "input_ids",
    labels: str | None = "labels",
) -> DataFrame:
    """(shard, n_tokens[, n_labels][, n_chunks]).  Uses a stored
    ``n_tokens`` column when present so the id arrays are not read; labels
    are sized only when ``labels`` is asked for (the J2 check)."""
    if "n_tokens" in shards.columns:
        agg = [F.sum("n_tokens").cast("long").alias("n_tokens")]
    else:
        agg = [F.sum(F.size(ids)).cast("long").alias("n_tokens")]
    if labels:
        agg.append(F.sum(F.size(labels)).cast("long").alias("n_labels"))
    man = shards.groupBy("shard").agg(*agg)
    if chunk_size:
        man = man.withColumn("n_chunks", F.expr(f"n_tokens div {int(chunk_size)}"))
    return man


def npy_manifest(listing: DataFrame, header_bytes: int = 128, bytes_per_token: int = 4) -> DataFrame:
    """S5 for flat ``.npy`` files: tokens = ``(bytes - header) div 4`` from a
    file listing ``(path, length)`` (e.g. the ``binaryFile`` source with the
    content column pruned); its ``shard`` column is kept if it has one."""
    return listing.select(
        "path", *(c for c in ("shard",) if c in listing.columns), F.expr(f"(length - {int(header_bytes)}) div {int(bytes_per_token)}").alias("n_tokens")
    )


def require_shards(manifest: DataFrame, where: str = "") -> DataFrame:
    """Error when no shard matches."""
    if manifest.isEmpty():
        raise ValueError("the manifest lists no shard" + (f" ({where})" if where else ""))
    return manifest


def first_shards(manifest: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` shards by name (demo); ``None``/0 keeps all."""
    if not n:
        return manifest
    return manifest.orderBy("shard").limit(int(n))


def stripe_workers(manifest: DataFrame, num_workers: int) -> DataFrame:
    """Worker ``w`` gets every ``num_workers``-th shard of the sorted list."""
    if num_workers <= 0:
        raise ValueError("num_workers must be positive")
    # The manifest holds one row per shard; ordering it in one task is fine.
    rn = F.row_number().over(Window.orderBy("shard")) - 1
    return manifest.withColumn("worker", F.pmod(rn, F.lit(num_workers)).cast("int"))


def shuffle_key(seed: int, epoch: int | Column, *cols: str) -> Column:
    e = epoch.cast("string") if isinstance(epoch, Column) else F.lit(str(epoch))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), e, *[F.col(c).cast("string") for c in cols]))


def chunk_keys(manifest: DataFrame, *cols: str) -> DataFrame:
    """(cols..., chunk): one row per chunk of each manifest row, from its
    ``n_chunks``.  Slices of bounded size are spread before they are unfolded, so
    a hot shard is not unfolded in one array or one task.  Their number of tasks is
    given: merged by size, the few narrow slices would all be one task's."""
    last = F.col("n_chunks").cast("long") - 1
    slices = manifest.where(F.col("n_chunks") > 0).select(
        *cols, last.alias("_sl_last"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_chunks - 1) div {KEY_SLICE}"))).alias("_sl_slice")
    )
    first = F.col("_sl_slice") * KEY_SLICE
    in_slice = F.sequence(first, F.least(first + (KEY_SLICE - 1), F.col("_sl_last")))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return slices.repartition(n, *cols, "_sl_slice").select(*cols, F.explode(in_slice).alias("chunk"))


def order_shards(manifest: DataFrame, *, shuffle: bool = True, seed: int = 42, epoch: int = 0) -> DataFrame:
    """``shard_rank`` inside each worker (hash order, or name order)."""
    key = shuffle_key(seed, epoch, "shard") if shuffle else F.col("shard")
    w = Window.partitionBy("worker").orderBy(key, "shard")
    return manifest.withColumn("shard_rank", (F.row_number().over(w) - 1).cast("int"))


def order_chunks(
    chunks: DataFrame,
    *,
    shuffle: bool = False,
    seed: int = 42,
    epoch: int = 0,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """``chunk_rank`` inside each shard.  Unshuffled it is ``chunk``;
    shuffled it is the rank of the hash key, computed without sending a whole
    shard to one task.  With a ``manifest`` (``n_chunks`` per shard) the keys
    are generated from it, so the wide chunk table is not computed twice."""
    if not shuffle:
        return chunks.withColumn("chunk_rank", F.col("chunk").cast("long"))
    if manifest is not None:
        keys = chunk_keys(manifest, "shard")
    else:
        keys = chunks.select("shard", "chunk")
    keys = keys.select("shard", "chunk", shuffle_key(seed, epoch, "shard", "chunk").alias("_sl_key"))
    ranked = ordinal(keys, ["shard"], ["_sl_key", "chunk"], "chunk_rank").drop("_sl_key")
    return chunks.join(ranked, ["shard", "chunk"]) if manifest is None else _look_up_ranks(chunks, ranked)


def _look_up_ranks(chunks: DataFrame, ranked: DataFrame) -> DataFrame:
    """``chunks`` joined with the ranks of chunks 0, 1, ... of each shard.  The ranks, eight
    bytes each, are sent to the chunks as an array a slice; where they are too many for
    that, the chunks are shuffled to them."""
    piece = F.expr(f"chunk div {RANK_SLICE}").alias("_sl_slice")
    held = ranked.groupBy("shard", piece).agg(F.sort_array(F.collect_list(F.struct("chunk", "chunk_rank"))).alias("_sl_ranks"))
    slices = materialize(held.select("shard", "_sl_slice", F.col("_sl_ranks.chunk_rank").alias("_sl_ranks")), "chunk-ranks")
    if slices.limit(RANK_SLICES + 1).count() > RANK_SLICES:
        ranks = slices.select("shard", "_sl_slice", F.posexplode("_sl_ranks").alias("_sl_at", "chunk_rank"))
        ranks = ranks.select("shard", (F.col("_sl_slice") * RANK_SLICE + F.col("_sl_at")).alias("chunk"), "chunk_rank")
        return chunks.join(ranks, ["shard", "chunk"])
    rows = chunks.withColumn("_sl_slice", piece).join(F.broadcast(slices), ["shard", "_sl_slice"])
    rank = F.get("_sl_ranks", F.expr(f"cast(chunk % {RANK_SLICE} as int)"))
    return rows.select(*chunks.columns, rank.alias("chunk_rank")).where("chunk_rank is not null")


def shard_bases(ordered_manifest: DataFrame) -> DataFrame:
    """Per shard: first sample number in its worker's sequence."""
    w = Window.partitionBy("worker").orderBy("shard_rank").rowsBetween(Window.unboundedPreceding, -1)
    return ordered_manifest.withColumn("seq_base", F.coalesce(F.sum("n_chunks").over(w), F.lit(0)).cast("long"))


def sample_sequence(chunks_ranked: DataFrame, ordered_manifest: DataFrame) -> DataFrame:
    """``seq`` = position of each chunk in its worker's stream
    (shard order, then chunk order): base offset of the shard + rank."""
    bases = shard_bases(ordered_manifest).select("shard", "worker", "shard_rank", "seq_base")
    out = chunks_ranked.join(broadcast_if_small(bases), "shard")
    return out.withColumn("seq", F.col("seq_base") + F.col("chunk_rank")).drop("seq_base")


def assign_batches(samples: DataFrame, batch_size: int) -> DataFrame:
    """W8 (row form): ``batch_id`` and ``pos_in_batch`` per sample; the last
    partial batch of a worker is kept.  Delivery order is ``(batch_id, worker)``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    return samples.withColumn("batch_id", F.expr(f"seq div {int(batch_size)}")).withColumn(
        "pos_in_batch", F.expr(f"seq % {int(batch_size)}").cast("int")
    )


def stack_batches(
    samples: DataFrame, batch_size: int, ids: str = "input_ids", labels: str = "labels"
) -> DataFrame:
    """W8 (stacked form, A3, P12): one row per (worker, batch_id) with int64
    sample arrays and all-ones attention masks.  Groups hold at most
    ``batch_size`` samples."""
    keys = ["worker", "batch_id"]
    # dealt first: grouping on the map side would only sort the arrays once more
    return gather_batches(assign_batches(samples, batch_size).repartition(*keys), keys, ids, labels)


def gather_batches(
    rows: DataFrame, keys: list[str], ids: str = "input_ids", labels: str = "labels", sort_by: list[str] | None = None
) -> DataFrame:
    """Samples that agree in ``keys`` (those of one batch) stacked in ``seq`` order.
    Masked runs, where samples carry them, are shipped in place of labels; ``sort_by``
    sorts the batches of a task, before their arrays are widened."""
    runs = "masked" in rows.columns
    held = rows.select(*keys, F.struct("seq", ids, "masked" if runs else labels).alias("_sl_sample"))
    gathered = held.groupBy(*keys).agg(F.sort_array(F.collect_list("_sl_sample")).alias("_s"))
    if sort_by:
        gathered = gathered.sortWithinPartitions(*sort_by)
    return gathered.select(
        *keys,
        F.size("_s").alias("n_samples"),
        F.transform("_s", lambda s: wide_ids(s[ids])).alias("input_ids"),
        F.transform("_s", lambda s: wide_ids(labels_from_runs(s[ids], s["masked"]) if runs else s[labels])).alias("labels"),
        F.transform("_s", lambda s: attention_mask(s[ids])).alias("attention_mask"),
    )


def epoch_order(
    manifest: DataFrame,
    n_epochs: int,
    batch_size: int,
    *,
    num_workers: int,
    shuffle_shards: bool = True,
    shuffle_chunks: bool = True,
    seed: int = 42,
) -> DataFrame:
    """W4-W8 for all epochs at once: (epoch, worker, batch_id, pos_in_batch,
    shard, chunk), a narrow table from the manifest (``n_chunks`` per shard).
    Token arrays are neither read nor moved: an epoch of training looks its
    windows up by ``(shard, chunk)``.  Epoch ``e`` has the order the operators
    above give with ``epoch=e``; an empty manifest gives no rows."""
    if n_epochs <= 0:
        raise ValueError("n_epochs must be positive")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(int(n_epochs) - 1))).alias("epoch")
    man = stripe_workers(manifest, num_workers).select("shard", "worker", "n_chunks", epochs)
    epoch = F.col("epoch")
    key = shuffle_key(seed, epoch, "shard") if shuffle_shards else F.col("shard")
    # One row per shard and epoch, as small as the manifest.
    earlier = Window.partitionBy("epoch", "worker").orderBy(key, "shard").rowsBetween(Window.unboundedPreceding, -1)
    man = man.withColumn("seq_base", F.coalesce(F.sum("n_chunks").over(earlier), F.lit(0)).cast("long"))
    chunks = chunk_keys(man, "epoch", "worker", "shard", "seq_base")
    if shuffle_chunks:
        keyed = chunks.withColumn("_sl_key", shuffle_key(seed, epoch, "shard", "chunk"))
        chunks = ordinal(keyed, ["epoch", "shard"], ["_sl_key", "chunk"], "chunk_rank")
    else:
        chunks = chunks.withColumn("chunk_rank", F.col("chunk"))
    rows = chunks.withColumn("seq", F.col("seq_base") + F.col("chunk_rank"))
    return assign_batches(rows, batch_size).select("epoch", "worker", "batch_id", "pos_in_batch", "shard", "chunk")


def order_key(seed: int, epoch: Column, shard: Column) -> Column:
    """Key of a shard's chunk order in an epoch."""
    return F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), shard)


def keyed_order(
    manifest: DataFrame,
    n_epochs: int,
    batch_size: int,
    *,
    num_workers: int,
    shuffle_shards: bool = True,
    seed: int = 42,
    first_epoch: int = 0,
    first_batch: int = 0,
) -> DataFrame:
    """W4-W8 with the chunks of a shard in a keyed permutation (``permutation``): the
    columns of ``epoch_order``, its shards and batches, another order of the chunks.

    Every sample's chunk is computed from its place alone: no chunk row is sorted or
    shuffled (slices of places are dealt to tasks, ``KEY_SLICE`` each).  Training
    resumes at ``first_batch`` of ``first_epoch`` (of every worker): earlier places of
    that epoch are not unfolded."""
    if n_epochs <= 0 or batch_size <= 0 or first_batch < 0:
        raise ValueError("n_epochs and batch_size must be positive, first_batch not negative")
    epochs = F.explode(F.sequence(F.lit(int(first_epoch)), F.lit(int(first_epoch) + int(n_epochs) - 1))).alias("epoch")
    man = stripe_workers(manifest, num_workers).select("shard", "worker", "n_chunks", epochs)
    key = shuffle_key(seed, F.col("epoch"), "shard") if shuffle_shards else F.col("shard")
    earlier = Window.partitionBy("epoch", "worker").orderBy(key, "shard").rowsBetween(Window.unboundedPreceding, -1)
    man = man.withColumn("seq_base", F.coalesce(F.sum("n_chunks").over(earlier), F.lit(0)).cast("long"))
    start = F.when(F.col("epoch") == int(first_epoch), F.lit(int(first_batch) * int(batch_size))).otherwise(0) - F.col("seq_base")
    start = F.greatest(start, F.lit(0)).cast("long")
    man = man.withColumn("_sl_from", start).withColumn("_sl_n", F.col("n_chunks").cast("long")).where("_sl_from < _sl_n")
    left = man.withColumn("n_chunks", F.col("_sl_n") - F.col("_sl_from"))
    places = chunk_keys(left, "epoch", "worker", "shard", "seq_base", "_sl_from", "_sl_n")
    place = F.col("chunk") + F.col("_sl_from")
    rows = places.withColumn("seq", F.col("seq_base") + place).withColumn(
        "chunk", at_place(place, F.col("_sl_n"), order_key(seed, F.col("epoch"), F.col("shard")))
    )
    return assign_batches(rows, batch_size).select("epoch", "worker", "batch_id", "pos_in_batch", "shard", "chunk")


def worker_batches(dealt: DataFrame, batch_size: int) -> DataFrame:
    """(worker, n): batches of each worker, from the dealt manifest alone."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    chunks = dealt.groupBy("worker").agg(F.sum("n_chunks").alias("chunks")).where("chunks > 0")
    return chunks.select("worker", F.expr(f"(chunks + {int(batch_size) - 1}) div {int(batch_size)}").alias("n"))


def batch_keys(counts: DataFrame) -> DataFrame:
    """(worker, batch_id) of every batch, from ``worker_batches`` alone: unfolded in
    slices of bounded size, without reading a sample."""
    return chunk_keys(counts.withColumnRenamed("n", "n_chunks"), "worker").withColumnRenamed("chunk", "batch_id")


def delivery_order(batches: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """W8 delivery: global position of each ``(worker, batch_id)`` when
    batches are taken round-robin over workers and an exhausted worker is
    skipped: ``sum_w' min(n_w', b) + #{w' < w : n_w' > b}`` with ``n_w`` the
    batch count of worker ``w``.  The counts have one row per worker (bounded
    by the worker count), so they are read once and inlined; give them
    (``worker_batches``) where ``batches`` holds token arrays, which a count
    would compute."""
    if counts is None:
        counts = batches.groupBy("worker").agg((F.max("batch_id") + 1).alias("n"))
    counts = counts.collect()
    b, w = F.col("batch_id"), F.col("worker")
    per_worker = F.array(
        *[F.struct(F.lit(int(r["worker"])).alias("w"), F.lit(int(r["n"])).cast("long").alias("n")) for r in counts]
    ).cast("array<struct<w:int,n:bigint>>")
    before = F.aggregate(
        per_worker,
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.least(x["n"], b) + F.when((x["w"] < w) & (x["n"] > b), 1).otherwise(0),
    )
    return batches.withColumn("delivery", before.cast("long"))


def split_ranks(batches: DataFrame, world_size: int) -> DataFrame:
    """Process of each batch.  The delivered stream is dealt round-robin
    to the processes, so ``rank = delivery mod world_size`` when the batches
    carry a ``delivery`` column (``delivery_order``), else ``batch_id mod
    world_size``."""
    if world_size <= 0:
        raise ValueError("world_size must be positive")
    pos = F.col("delivery") if "delivery" in batches.columns else F.col("batch_id")
    return batches.withColumn("rank", F.pmod(pos, F.lit(world_size)).cast("int"))


def pair_shards(ids_manifest: DataFrame, labels_manifest: DataFrame) -> DataFrame:
    """Pair id and label shards by name (full outer join) with a status;
    a missing side is reported instead of shifting every later pair."""
    a = ids_manifest.select("shard", F.col("n_tokens").alias("n_ids"))
    b = labels_manifest.select("shard", F.col("n_tokens").alias("n_labels"))
    j = a.join(b, "shard", "full_outer")
    status = (
        F.when(F.col("n_ids").isNull(), "missing_ids")
        .when(F.col("n_labels").isNull(), "missing_labels")
        .when(F.col("n_ids") != F.col("n_labels"), "length_mismatch")
        .otherwise("ok")
    )
    return j.withColumn("status", status)


def check_lengths(manifest: DataFrame, strict: bool = False) -> DataFrame:
    """Per shard ``n_tokens`` vs ``n_labels``; ``strict`` raises on a mismatch."""
    rep = manifest.select("shard", "n_tokens", "n_labels", (F.col("n_tokens") == F.col("n_labels")).alias("lengths_match"))
    if strict:
        bad = rep.where(~F.col("lengths_match")).select("shard").limit(5).collect()
        if bad:
            raise ValueError(f"input_ids and labels lengths differ in shards {[r.shard for r in bad]}")
    return rep


def deal_shards(
    manifest: DataFrame,
    *,
    num_workers: int,
    shuffle_shards: bool = True,
    seed: int = 42,
    epoch: int = 0,
    demo_shards: int | None = None,
) -> DataFrame:
    """The manifest with worker and shard_rank, written once (one row per
    shard) for the semi-join, the chunk keys, the sequence bases and the counts."""
    man = first_shards(manifest, demo_shards)
    man = order_shards(stripe_workers(man, num_workers), shuffle=shuffle_shards, seed=seed, epoch=epoch)
    return require_shards(materialize(man, "manifest"))


def number_samples(
    chunks: DataFrame, dealt: DataFrame, *, shuffle_chunks: bool = False, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """Chunks of the dealt shards with worker, shard_rank, chunk_rank, seq."""
    picked = chunks.join(broadcast_if_small(dealt.select("shard")), "shard", "left_semi")
    ranked = order_chunks(picked, shuffle=shuffle_chunks, seed=seed, epoch=epoch, manifest=dealt)
    return sample_sequence(ranked, dealt)


def feed_samples(
    chunks: DataFrame,
    manifest: DataFrame,
    *,
    num_workers: int,
    shuffle_shards: bool = True,
    shuffle_chunks: bool = False,
    seed: int = 42,
    epoch: int = 0,
    demo_shards: int | None = None,
) -> DataFrame:
    """W3-W7 together: chunks with worker, shard_rank, chunk_rank, seq."""
    dealt = deal_shards(
        manifest, num_workers=num_workers, shuffle_shards=shuffle_shards, seed=seed, epoch=epoch, demo_shards=demo_shards
    )
    return number_samples(chunks, dealt, shuffle_chunks=shuffle_chunks, seed=seed, epoch=epoch)
