"""Token streams stored in order, so that packing moves no token.

``in_stream_order`` sends the prompt texts (about a byte a token) by ranges of
(group, order) to tasks; the tokens of a task are then a stretch of each group's
stream.  ``with_place`` notes where every row lies in its task's stretch, and
``place_offsets`` adds the earlier stretches' lengths (a row a task and group).

``joined_runs`` joins neighbouring rows of a stored table in the task that reads
them and cuts them at multiples of a block size: only the block at either end of
a stretch is left in pieces.  Rows may come in any order and any split: what does
not follow its predecessor just starts another piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.functions.tokenizer import joined_sides
from shardloom.functions.tokens import PACKED, packed_ids
from shardloom.operators.ordering import broadcast_if_small, join_on_keys
from shardloom.session import ship_package

#: Stretch (task) of a row, tokens of its group before it there, and whether it ties with the row before.
PLACE = ("place_part", "place_start", "place_tie")
#: Tokens that ``joined_runs`` holds before it gives out what is whole, and that an output batch holds.
HELD = 1 << 20


def in_stream_order(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One exchange by ranges; adaptive execution merges neighbouring ranges."""
    keys = [*group_cols, *order_cols]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _placed(batches: Iterator, groups: Sequence[str], orders: Sequence[str], max_len: int | None) -> Iterator:
    """Arrow batches of a task's rows with ``PLACE``."""
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    group = order = None
    total, started = 0, False
    for batch in batches:
        starts, ties = [], []
        rows = zip(
            zip(*(batch.column(c).to_pylist() for c in groups)),
            zip(*(batch.column(c).to_pylist() for c in orders)),
            batch.column("length").to_pylist(),
        )
        for g, o, n in rows:
            if not started or g != group:
                group, order, total, started = g, None, 0, True
            starts.append(total)
            keep = max_len is None or (n is not None and n <= max_len)
            ties.append(keep and order == o)
            if keep:
                order, total = o, total + (n or 0)
        place = [pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64()), pa.array(ties, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *place], names=[*batch.schema.names, *PLACE])


def _place_fields() -> list[T.StructField]:
    return T._parse_datatype_string("place_part int, place_start long, place_tie boolean").fields


def with_place(tok: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], max_len: int | None) -> DataFrame:
    """Rows in stream order (``length`` tokens each) with ``PLACE``; rows over
    ``max_len`` count as absent."""
    ship_package(tok.sparkSession)
    schema = T.StructType([*tok.schema.fields, *_place_fields()])
    groups, orders = list(group_cols), list(order_cols)
    return tok.mapInArrow(lambda batches: _placed(batches, groups, orders, max_len), schema)


def tokens_in_place(
    prompts: DataFrame, tokenizer, keys: Sequence[str], group_cols: Sequence[str], order_cols: Sequence[str], max_len: int | None,
    *, src: str = "inputs", tgt: str = "outputs", packed: bool = False,
) -> DataFrame:
    """(keys..., input_ids, length, n_masked) of prompts in stream order, with ``PLACE``:
    ``tokenize`` and ``with_place`` in one Python pass, so ids leave Python once.
    ``packed`` gives them as ``PACKED`` in place of an array."""
    spark = prompts.sparkSession
    ship_package(spark)
    keys, groups, orders = list(keys), list(group_cols), list(order_cols)
    encode = tokenizer.sides_encoder(spark, keys, src, tgt)
    ids = T.StructField(PACKED, T.BinaryType()) if packed else T.StructField("input_ids", T.ArrayType(T.IntegerType(), False))
    counts = T._parse_datatype_string("length int, n_masked int").fields
    schema = T.StructType([*(prompts.schema[k] for k in keys), ids, *counts, *_place_fields()])

    def run(batches: Iterator) -> Iterator:
        joined = (joined_sides(b, keys) for b in encode(batches))
        return _placed(map(_with_packed, joined) if packed else joined, groups, orders, max_len)

    return prompts.select(*keys, src, tgt).mapInArrow(run, schema)


def _with_packed(batch):
    """An Arrow batch with ``PACKED`` in place of ``input_ids``."""
    at, lists = batch.schema.get_field_index("input_ids"), batch.column("input_ids")
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    return batch.set_column(at, PACKED, packed_ids(flat, ends - ends[0], lists.is_null() if lists.null_count else None))


def place_offsets(tok: DataFrame, group_cols: Sequence[str], length: str, out: str) -> DataFrame:
    """``out``: tokens of the group before the row.  Rows that tie fail the job."""
    group_cols = list(group_cols)
    totals = tok.groupBy(*group_cols, "place_part").agg(F.sum(length).alias("_sl_total"))
    before = Window.partitionBy(*group_cols).orderBy("place_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*group_cols, "place_part", F.coalesce(F.sum("_sl_total").over(before), F.lit(0)).alias("_sl_base"))
    rows = join_on_keys(tok, broadcast_if_small(bases), [*group_cols, "place_part"])
    tie = F.raise_error(F.lit("rows of a group tie in their order columns; the order must be total")).cast("long")
    offset = F.when(F.col("place_tie"), tie).otherwise(F.col("_sl_base") + F.col("place_start"))
    return rows.withColumn(out, offset.cast("long")).drop("_sl_base", *PLACE)


class _Run:
    """Consecutive tokens of a group from ``pos`` on, not yet given out."""

    def __init__(self, key: tuple, pos: int):
        self.key, self.pos, self.end, self.ids, self.masked = key, pos, pos, [], []

    def add(self, ids, masked) -> None:
        for at, n in zip(masked[::2], masked[1::2]):
            self.masked.append((self.end + int(at), int(n)))
        self.ids.append(ids)
        self.end += len(ids)

    def cut(self, block: int, last: bool, packed: bool = False):
        """Arrow columns (chunk, pos, ids, masked, n_tokens) of the blocks that
        are whole, and with ``last`` of the rest; the rest stays."""
        import numpy as np
        import pyarrow as pa

        stop = self.end if last else self.end // block * block
        if stop <= self.pos:
            return None
        edges = np.array([self.pos, *range((self.pos // block + 1) * block, stop, block), stop], dtype=np.int64)
        flat = np.concatenate(self.ids)
        kept = stop - self.pos
        self.ids = [flat[kept:]] if kept < len(flat) else []
        pairs: list[list[int]] = [[] for _ in edges[1:]]
        later = []
        for at, n in self.masked:
            while n > 0 and at < stop:
                k = int(np.searchsorted(edges, at, side="right")) - 1
                m = min(n, int(edges[k + 1]) - at)
                pairs[k] += (at - int(edges[k]), m)
                at, n = at + m, n - m
            if n > 0:
                later.append((at, n))
        self.masked, start = later, self.pos
        self.pos = stop
        if packed:
            lists = packed_ids(flat[:kept], edges - start)
        else:
            lists = pa.ListArray.from_arrays(pa.array((edges - start).astype(np.int32)), pa.array(flat[:kept], pa.int32()))
        return [
            pa.array(edges[:-1] // block), pa.array(edges[:-1]), lists,
            pa.array(pairs, pa.list_(pa.int32())), pa.array(np.diff(edges).astype(np.int32)),
        ]


def joined_runs(rows: DataFrame, group_cols: Sequence[str], block_size: int) -> DataFrame:
    """(group..., pos, input_ids, masked) -> pieces (group..., chunk, pos, input_ids,
    masked, n_tokens) that lie in one block of ``block_size`` each.  Rows with ``PACKED``
    give pieces with ``PACKED``, in place of ``input_ids``."""
    if block_size <= 0:
        raise ValueError("the block size must be positive")
    ship_package(rows.sparkSession)
    groups, block = list(group_cols), int(block_size)
    packed = PACKED in rows.columns
    held = PACKED if packed else "input_ids"
    cols = f"chunk long, pos long, {held} {'binary' if packed else 'array<int>'}, masked array<int>, n_tokens int"
    schema = T.StructType([*(rows.schema[c] for c in groups), *T._parse_datatype_string(cols).fields])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [*groups, "chunk", "pos", held, "masked", "n_tokens"]
        types = None
        run = None

        def give(last):
            columns = run.cut(block, last, packed) if run else None
            if columns:
                keys = [pa.array([k] * len(columns[0]), t) for k, t in zip(run.key, types)]
                yield pa.RecordBatch.from_arrays([*keys, *columns], names=names)

        for batch in batches:
            types = [batch.schema.field(c).type for c in groups]
            ids, masked = batch.column(held), batch.column("masked")
            if packed:
                own = [np.frombuffer(x or b"", "<i4") for x in ids.to_pylist()]  # copies, as the batch goes
            else:
                ids_off, ids_val = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            m_off, m_val = masked.offsets.to_numpy(), masked.values.to_numpy(zero_copy_only=False)
            keys = zip(*(batch.column(c).to_pylist() for c in groups))
            for i, (key, pos) in enumerate(zip(keys, batch.column("pos").to_pylist())):
                if run is None or key != run.key or pos != run.end:
                    yield from give(True)
                    run = _Run(key, pos)
                run.add(own[i] if packed else ids_val[ids_off[i] : ids_off[i + 1]].copy(), m_val[m_off[i] : m_off[i + 1]].tolist())
                if run.end - run.pos >= HELD:
                    yield from give(False)
        yield from give(True)

    return rows.select(*groups, "pos", held, "masked").mapInArrow(run, schema)
