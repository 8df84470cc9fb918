"""Flattening and block packing of token rows.

``pack_blocks`` concatenates the rows of each group in order and cuts the
stream into ``block_size`` blocks (tail dropped unless ``keep_tail``).  It
never makes one row per token:

1. offsets: exclusive running total of ``length`` per group on the narrow
   ``(group, order, length)`` table (two-level, see ``ordering``);
2. each row becomes one *fragment* per block it touches
   (``explode(sequence(first, last))``), sliced to that block;
3. ``groupBy(group, chunk)`` gathers at most ``block_size`` tokens per key
   (bounded groups) and orders the fragments by their start offset.

The token payload is shuffled twice (join on the row key, then by block);
everything else moves narrow rows only.  Feed it a materialised token table
so tokenisation is not recomputed by the two reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.tokens import PACKED, arrays_from_packed, labels_from_mask, labels_from_runs
from shardloom.operators.ordering import join_on_keys, ordinal, running_total
from shardloom.operators.streams import PLACE, joined_runs, place_offsets

_OFF = "_sl_off"


def _bq(name: str) -> str:
    return f"`{name}`"


def with_offsets(
    tok: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    length: str = "length",
    out: str = "offset",
) -> DataFrame:
    """Narrow table (group, order, length, offset): start of each row in its group stream."""
    lens = tok.select(*group_cols, *order_cols, length)
    return running_total(lens, group_cols, order_cols, length, out)


def _with_stream_offset(tok, group_cols, order_cols, length, payload) -> DataFrame:
    """Rows with ``_OFF``: from their place in a stored table in stream order
    (``streams.in_stream_order``), else by a join with ``with_offsets``."""
    if set(PLACE) <= set(tok.columns):
        return place_offsets(tok, group_cols, length, _OFF).select(*group_cols, *order_cols, length, *payload, _OFF)
    offs = with_offsets(tok, group_cols, order_cols, length, _OFF).drop(length)
    return join_on_keys(tok.select(*group_cols, *order_cols, length, *payload), offs, group_cols + order_cols)


def pack_stream(tok: DataFrame, group_cols: Sequence[str], block_size: int, mask: str = "n_masked") -> DataFrame:
    """A6 of a table in stream order: (group..., chunk, input_ids, masked, n_tokens),
    tail kept, as pieces.  Neighbouring rows are joined where they are read; a block
    that two tasks share is left in pieces for ``whole_blocks``.  Stored ``PACKED`` ids
    stay packed."""
    rows = place_offsets(tok, group_cols, "length", _OFF)
    runs = F.when(F.col(mask) > 0, F.array(F.lit(0), F.col(mask).cast("int"))).otherwise(F.array().cast("array<int>"))
    ids = PACKED if PACKED in tok.columns else "input_ids"
    return joined_runs(rows.where("length > 0").select(*group_cols, F.col(_OFF).alias("pos"), ids, runs.alias("masked")), group_cols, block_size)


def whole_blocks(pieces: DataFrame, group_cols: Sequence[str], block_size: int, *, keep_tail: bool, labels: str | None = "labels") -> DataFrame:
    """Blocks of ``joined_runs``' pieces: whole ones pass, the few parts of a shared
    block meet by one exchange.  ``labels`` is derived from the masked runs, and
    ``input_ids`` from ``PACKED`` ids, by readers that select them."""
    keys, packed = [*group_cols, "chunk"], PACKED in pieces.columns
    ids = PACKED if packed else "input_ids"
    whole = F.col("n_tokens") == int(block_size)
    parts = pieces.where(~whole).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "n_tokens", ids, "masked"))).alias("_parts")
    )
    at = F.col("_parts")[0]["pos"]
    moved = F.transform(
        "_parts", lambda p: F.transform(p["masked"], lambda x, i: x + F.when(i % 2 == 0, (p["pos"] - at).cast("int")).otherwise(0))
    )
    n = F.aggregate("_parts.n_tokens", F.lit(0), lambda a, x: a + x)
    joined = F.expr(f"aggregate(_parts.{ids}, X'', (a, x) -> concat(a, x))") if packed else F.flatten("_parts.input_ids")
    parts = parts.select(*keys, joined.alias(ids), F.flatten(moved).alias("masked"), n.alias("n_tokens"))
    blocks = pieces.where(whole).select(*keys, ids, "masked", "n_tokens").unionByName(parts if keep_tail else parts.where(whole))
    if packed:
        blocks = blocks.withColumn("input_ids", arrays_from_packed(blocks.sparkSession))
    return blocks.withColumn(labels, labels_from_runs("input_ids", "masked")) if labels else blocks


def pack_blocks(
    tok: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    block_size: int,
    *,
    ids: str = "input_ids",
    labels: str | None = "labels",
    length: str | None = "length",
    keep_tail: bool = False,
    chunk_col: str = "chunk",
    mask: str | None = None,
) -> DataFrame:
    """(group..., chunk, input_ids[, labels]) blocks of ``block_size`` tokens.

    ``order_cols`` must be unique within a group (else the job fails); null
    keys are kept.  A group shorter than one block gives no rows (unless
    ``keep_tail``).  Empty rows are skipped.

    ``mask`` names a column holding each row's masked-prefix length (labels
    = ids with that prefix set to -100).  Then only ids and one number per
    fragment cross the shuffles, and the label arrays are rebuilt per block.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    group_cols, order_cols = list(group_cols), list(order_cols)
    B = int(block_size)
    if length is None or length not in tok.columns:
        tok = tok.withColumn("_sl_len", F.size(ids))
        length = "_sl_len"

    if mask:
        payload = [ids, mask]
    else:
        payload = [ids] + ([labels] if labels else [])
    rows = _with_stream_offset(tok, group_cols, order_cols, length, payload)
    return _gather_blocks(
        rows, group_cols, B, ids=ids, labels=labels, length=length, keep_tail=keep_tail, chunk_col=chunk_col, mask=mask
    )


def _gather_blocks(rows, group_cols, B, *, ids, labels, length, keep_tail, chunk_col, mask=None):
    """Rows with a stream offset (``_OFF``) and a length -> blocks of ``B``.

    A row is unfolded into the pieces themselves, so a long row is not copied
    once a block, and pieces go to their block's task before they are grouped."""
    rows = rows.where(F.col(length) > 0)
    off, n = _bq(_OFF), _bq(length)
    row_off, row_n = F.col(_OFF), F.col(length)

    def piece(chunk):
        lo = F.greatest(row_off, chunk * B)
        hi = F.least(row_off + row_n, (chunk + 1) * B)
        start, cnt = (lo - row_off + 1).cast("int"), (hi - lo).cast("int")
        cols = [chunk.alias("chunk"), lo.alias("pos"), cnt.alias("n"), F.slice(ids, start, cnt).alias("ids")]
        if mask:
            # masked tokens of this piece: the part of the prefix inside it
            cols.append(F.least(F.greatest(F.col(mask) - (lo - row_off), F.lit(0)), cnt).cast("int").alias("m"))
        elif labels:
            cols.append(F.slice(labels, start, cnt).alias("labels"))
        return F.struct(*cols)

    touched = F.expr(f"sequence({off} div {B}, ({off} + {n} - 1) div {B})")
    frag = rows.select(*group_cols, F.explode(F.transform(touched, piece)).alias("_sl_piece"))
    frag = frag.select(*group_cols, F.col("_sl_piece.chunk").alias(chunk_col), F.col("_sl_piece.n").alias("_sl_n"), "_sl_piece")
    held = F.struct("_sl_piece.pos", "_sl_piece.ids", *(["_sl_piece.m"] if mask else ["_sl_piece.labels"] if labels else []))
    frag = frag.select(*group_cols, chunk_col, "_sl_n", held.alias("_sl_piece")).repartition(*group_cols, chunk_col)
    gathered = frag.groupBy(*group_cols, chunk_col).agg(
        F.sort_array(F.collect_list("_sl_piece")).alias("_parts"), F.sum("_sl_n").alias("_sl_n")
    )
    if not keep_tail:  # by the count, so readers of the keys alone move no arrays
        gathered = gathered.where(F.col("_sl_n") == B)
    cols = [*group_cols, chunk_col, F.flatten(F.col("_parts.ids")).alias(ids)]
    if mask and labels:
        cols.append(F.flatten(F.transform("_parts", lambda p: labels_from_mask(p["ids"], p["m"]))).alias(labels))
    elif labels:
        cols.append(F.flatten(F.col("_parts.labels")).alias(labels))
    return gathered.select(*cols)


def with_batch_index(
    tok: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], batch_size: int, out: str = "map_batch"
) -> DataFrame:
    """Index of the ``batch_size``-row batch each row falls in (per group, in
    order).  Packing with ``out`` as an extra group column drops the tail per
    batch instead of per group - the behaviour of a batched map that chunks
    each batch on its own."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    keys = tok.select(*group_cols, *order_cols)
    numbered = ordinal(keys, group_cols, order_cols, "_sl_rn").withColumn(out, F.expr(f"_sl_rn div {int(batch_size)}"))
    return join_on_keys(tok, numbered.drop("_sl_rn"), [*group_cols, *order_cols])


def require_blocks(shards: DataFrame, block_size: int, group_cols: Sequence[str], order_col: str, ids: str) -> None:
    """Fail unless every group is blocks 0, 1, ... of ``block_size`` tokens, the
    last one at most as long.  Reads the stored ``n_tokens`` where there is one."""
    n = F.col("n_tokens") if "n_tokens" in shards.columns else F.size(ids)
    per = shards.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.max(order_col).alias("last"),
        F.count_if(n == block_size).alias("full"),
        F.max(F.struct(F.col(order_col), n.alias("n")))["n"].alias("tail"),
    )
    whole = (F.col("last") == F.col("blocks") - 1) & (F.col("tail") <= block_size)
    whole &= F.col("full") == F.col("blocks") - F.when(F.col("tail") < block_size, 1).otherwise(0)
    if not per.where(~F.coalesce(whole, F.lit(False))).isEmpty():
        raise ValueError(f"the stored blocks are not {block_size} tokens each")


def cut_windows(
    shards: DataFrame,
    chunk_size: int,
    *,
    group_cols: Sequence[str] = ("shard",),
    order_col: str = "chunk",
    ids: str = "input_ids",
    labels: str | None = "labels",
    block_size: int | None = None,
) -> DataFrame:
    """Re-cut a packed table (tail kept) into ``chunk_size`` windows,
    dropping each group's tail.  The read-time window size is independent of
    the write-time block size.

    With ``block_size`` (a table written by ``pack_blocks``: every block but a
    group's last is full) each block's stream offset is ``chunk * block_size``
    and no running total or join is needed - one shuffle of the payload.  The
    stored blocks are checked first (one narrow aggregate).
    """
    group_cols = list(group_cols)
    if block_size is None:
        return pack_blocks(
            shards, group_cols, [order_col], chunk_size, ids=ids, labels=labels, length=None, keep_tail=False
        )
    require_blocks(shards, int(block_size), group_cols, order_col, ids)
    if "masked" in shards.columns and ids == "input_ids" and order_col == "chunk":
        pos = (F.col(order_col).cast("long") * int(block_size)).alias("pos")
        held = PACKED if PACKED in shards.columns else ids
        pieces = joined_runs(shards.select(*group_cols, pos, held, "masked"), group_cols, int(chunk_size))
        return whole_blocks(pieces, group_cols, int(chunk_size), keep_tail=False, labels=labels)
    payload = [ids] + ([labels] if labels else [])
    rows = shards.select(
        *group_cols,
        (F.col(order_col).cast("long") * int(block_size)).alias(_OFF),
        (F.col("n_tokens") if "n_tokens" in shards.columns else F.size(ids)).cast("int").alias("_sl_len"),
        *payload,
    )
    return _gather_blocks(
        rows, group_cols, int(chunk_size), ids=ids, labels=labels, length="_sl_len", keep_tail=False, chunk_col=order_col
    )


def flatten_tokens(
    tok: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    *,
    ids: str = "input_ids",
    labels: str | None = "labels",
    length: str = "length",
) -> DataFrame:
    """A5: one row per token (group..., pos, order..., input_id[, label]).

    ``pos`` is the token's position in its group stream.  This is the
    user-facing flat view; packing never builds it.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    payload = [ids] + ([labels] if labels else [])
    rows = _with_stream_offset(tok, group_cols, order_cols, length, payload)
    zipped = F.arrays_zip(*[F.col(c).alias(c) for c in payload])
    exploded = rows.select(*group_cols, *order_cols, _OFF, F.posexplode(zipped).alias("_i", "_t"))
    out = [*group_cols, (F.col(_OFF) + F.col("_i")).alias("pos"), *order_cols, F.col(f"_t.{ids}").alias("input_id")]
    if labels:
        out.append(F.col(f"_t.{labels}").alias("label"))
    return exploded.select(*out)


def chunk_counts(
    tok: DataFrame, block_size: int, group_cols: Sequence[str] = ("shard",), length: str = "length"
) -> DataFrame:
    """G3 per group: tokens, estimate ``floor(total / B)`` as the reader sizes
    itself, and the per-group count the packing actually emits."""
    B = int(block_size)
    return (
        tok.groupBy(*group_cols)
        .agg(F.sum(length).cast("long").alias("tokens"))
        .withColumn("chunks", F.expr(f"tokens div {B}"))
    )


def chunk_estimate(tok: DataFrame, block_size: int, group_cols: Sequence[str] = ("shard",), length: str = "length") -> DataFrame:
    """One row: total tokens, ``floor(sum(n)/B)`` (estimate) and
    ``sum(floor(n_g/B))`` (emitted, tail dropped per group)."""
    B = int(block_size)
    per = chunk_counts(tok, B, group_cols, length)
    return per.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("total_tokens"),
        F.expr(f"coalesce(sum(tokens), 0) div {B}").cast("long").alias("estimated_chunks"),
        F.coalesce(F.sum("chunks"), F.lit(0)).cast("long").alias("exact_chunks"),
    )
