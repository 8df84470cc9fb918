"""Sample limit (P10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.ordering import join_on_keys, ordinal


def sample_limit(
    df: DataFrame,
    n: int | None,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows by ``order_cols`` (per group if given); 0/None keeps all.

    Per group this is ``row_number() <= n``; up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark plans it with a
    partial group limit before the shuffle, so at most ``n`` rows per group and
    map task move.  Beyond that the narrow keys are numbered in slices of
    bounded size and the rows picked by a semi join (``order_cols`` must then be
    unique within a group).  Without groups it is a top-n.
    """
    if not n:
        return df
    if not group_cols:
        return df.orderBy(*order_cols).limit(int(n))
    if int(n) > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        keys = [*group_cols, *order_cols]
        picked = ordinal(df.select(*keys), group_cols, order_cols, "_sl_rn").where(F.col("_sl_rn") < int(n))
        return join_on_keys(df, picked.select(*keys), keys, "left_semi")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_sl_rn", F.row_number().over(w)).where(F.col("_sl_rn") <= int(n)).drop("_sl_rn")
