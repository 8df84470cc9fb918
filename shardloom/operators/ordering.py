"""Exact running totals and row numbers per group, without a single-task window.

A plain ``sum(x) over (partition by g order by o)`` sends every row of a
group to one task; a group (one shard, one rank) may hold a third of all
rows.  The helpers here use two levels instead:

1. split each group into slices of bounded size: for one dense integer order
   key, ``key div 2^20`` (a slice holds at most 2^20 rows, keys being unique,
   and density bounds the number of slices); otherwise range-partition the (narrow) rows by ``(group, order)`` and pin
   the partition number by writing the narrow table once to the shared
   checkpoint folder;
2. per ``(group, partition)`` totals -> a table of at most
   ``partitions + groups`` rows -> base offset per ``(group, partition)`` by a
   window over that small table;
3. running total inside each ``(group, partition)`` slice (bounded by one
   range partition) plus its base.

Inputs should be narrow (keys and one number): callers join the result back
to wide rows on the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.session import materialize

_PART = "_sl_part"
_LOCAL = "_sl_local"
_BASE = "_sl_base"
_TOTAL = "_sl_total"

#: Largest number of (group, partition) base rows that is broadcast.
BROADCAST_ROWS = 500_000
#: Width of an order-key bucket for integer keys: a bucket holds at most this
#: many rows of a group (keys are unique within a group).
BUCKET_WIDTH = 1 << 20
#: Integer buckets are used only when keys are this dense or denser
#: (key span <= MAX_SPARSITY x rows in every group), so a group has at most
#: ~rows * MAX_SPARSITY / BUCKET_WIDTH buckets for the per-group base window.
MAX_SPARSITY = 64


def _dense_integer_key(df: DataFrame, group_cols: list[str], key: str) -> bool:
    """One scalar from an aggregate: are the keys dense in every group?"""
    span = F.max(key).cast("double") - F.min(key).cast("double") + F.lit(1.0)
    per = df.groupBy(*group_cols).agg((span / F.count(F.lit(1))).alias("_sl_sparsity"))
    worst = per.agg(F.max("_sl_sparsity")).first()[0]
    return worst is None or worst <= MAX_SPARSITY


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after checking its row count is within bounds."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns; null keys match each other, so no row of a
    null group or order key is lost."""
    renamed = right.withColumnsRenamed({c: f"_sl_key{i}" for i, c in enumerate(keys)})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_sl_key{i}")) for i, c in enumerate(keys)]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_sl_key{i}" for i in range(len(keys))])


def running_total(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    value: str | Column,
    out: str,
    *,
    inclusive: bool = False,
    num_parts: int | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over earlier rows of the group.

    ``order_cols`` must make the order total within a group: rows that tie
    would get totals that depend on the partition layout, so the job fails on
    them.  A null group is a group, a null order key comes first.
    ``inclusive`` adds the current row.  Nulls in ``value`` count as 0.
    Returns all input columns plus ``out`` (bigint).
    """
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    val = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0)).cast("long")

    integral = {"tinyint", "smallint", "int", "bigint"}
    if (
        num_parts is None
        and len(order_cols) == 1
        and dict(df.dtypes).get(order_cols[0]) in integral
        and _dense_integer_key(df, group_cols, order_cols[0])
    ):
        # Deterministic buckets of the key itself: no sampling job, no pinning write.
        key = f"`{order_cols[0]}`"
        bucket = F.coalesce(F.expr(f"cast({key} as bigint) div {BUCKET_WIDTH}"), F.lit(-(1 << 63)))
        keyed = df.withColumn("_sl_val", val).withColumn(_PART, bucket)
    else:
        keyed = df.withColumn("_sl_val", val)
        if num_parts:
            keyed = keyed.repartitionByRange(int(num_parts), *group_cols, *order_cols)
        else:
            # No fixed count: AQE merges adjacent range partitions to fit the
            # data, so slices stay contiguous and ordered.
            keyed = keyed.repartitionByRange(*group_cols, *order_cols)
        keyed = materialize(keyed.withColumn(_PART, F.spark_partition_id()), "ordered")

    totals = keyed.groupBy(*group_cols, _PART).agg(F.sum("_sl_val").alias(_TOTAL))
    before = Window.partitionBy(*group_cols).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *group_cols, _PART, F.coalesce(F.sum(_TOTAL).over(before), F.lit(0)).alias(_BASE)
    )

    end = Window.currentRow if inclusive else -1
    inside = (
        Window.partitionBy(_PART, *group_cols)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    # Equal keys share a slice, so a tie shows next to its twin (no further pass).
    before_it = Window.partitionBy(_PART, *group_cols).orderBy(*order_cols)
    tie = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.lag(c).over(before_it)) for c in order_cols])
    tie = tie & (F.row_number().over(before_it) > 1)
    total = F.coalesce(F.sum("_sl_val").over(inside), F.lit(0))
    message = f"rows of a group tie in {order_cols}; the order must be total"
    local = keyed.withColumn(_LOCAL, F.when(tie, F.raise_error(F.lit(message)).cast("long")).otherwise(total))
    joined = join_on_keys(local, broadcast_if_small(bases), [*group_cols, _PART])
    return joined.withColumn(out, (F.col(_LOCAL) + F.col(_BASE)).cast("long")).drop(
        _PART, _LOCAL, _BASE, "_sl_val"
    )


def ordinal(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    out: str,
    *,
    start: int = 0,
    num_parts: int | None = None,
) -> DataFrame:
    """Row number per group in ``order_cols`` order, starting at ``start``."""
    res = running_total(df, group_cols, order_cols, F.lit(1), out, num_parts=num_parts)
    if start:
        res = res.withColumn(out, F.col(out) + F.lit(start))
    return res
