"""Date windows (W1) and the window / shard of each corpus row.

Windows are ``[start + k*step, start + (k+1)*step)`` months for every ``k``
whose start is before ``end``; the last window is not clamped to ``end``.
Month arithmetic is ``add_months`` from the first start (no drift for start
days above 28, unlike repeated addition).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(str(d)).cast("date")


def shard_name(start: Column, end: Column) -> Column:
    """``shard_<start>_<end>`` with ISO dates."""
    return F.concat(F.lit("shard_"), start.cast("string"), F.lit("_"), end.cast("string"))


def date_windows(
    spark: SparkSession,
    start: str | _dt.date,
    end: str | _dt.date,
    step_months: int = 2,
) -> DataFrame:
    """One row per window: (window_idx, window_start, window_end, shard).

    No rows when ``start >= end``.  The table size is fixed by the arguments
    (months spanned / step), not by any data.
    """
    if step_months <= 0:
        raise ValueError("step_months must be positive")
    s, e = _date(start), _date(end)
    starts = F.when(s < e, F.sequence(s, F.date_sub(e, 1), F.expr(f"interval {step_months} month")))
    rows = spark.range(1).select(F.posexplode(F.coalesce(starts, F.array().cast("array<date>"))))
    rows = rows.select(
        F.col("pos").cast("long").alias("window_idx"),
        F.col("col").alias("window_start"),
        F.add_months(s, (F.col("pos") + 1) * step_months).alias("window_end"),
    )
    return rows.withColumn("shard", shard_name(F.col("window_start"), F.col("window_end")))


def assign_windows(
    df: DataFrame,
    date_col: str,
    start: str | _dt.date,
    end: str | _dt.date,
    step_months: int = 2,
) -> DataFrame:
    """Add ``window_idx, window_start, window_end, shard``; drop rows outside.

    Pure arithmetic per row (no join): a month-count estimate, corrected by one
    step using the exact ``add_months`` bounds.
    """
    s, e = _date(start), _date(end)
    d = F.col(date_col)
    guess = F.floor(F.months_between(d, s) / step_months).cast("int")
    lo = F.add_months(s, guess * step_months)
    hi = F.add_months(s, (guess + 1) * step_months)
    idx = F.when(d < lo, guess - 1).when(d >= hi, guess + 1).otherwise(guess)
    # The plain bounds on the date reach the scan; the exact ones below do not.
    df = scan_window(df, date_col, start, _last_end(start, end, step_months))
    out = df.withColumn("window_idx", idx.cast("long"))
    ws = F.add_months(s, F.col("window_idx").cast("int") * step_months)
    out = out.withColumn("window_start", ws).withColumn(
        "window_end", F.add_months(s, (F.col("window_idx").cast("int") + 1) * step_months)
    )
    out = out.where((F.col("window_idx") >= 0) & (F.col("window_start") < e) & (d >= s))
    return out.withColumn("shard", shard_name(F.col("window_start"), F.col("window_end")))


def _last_end(start, end, step_months: int) -> _dt.date:
    """End of the last window that starts before ``end``."""
    at = start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start))
    stop = end if isinstance(end, _dt.date) else _dt.date.fromisoformat(str(end))
    months = at.year * 12 + at.month - 1
    while _dt.date(months // 12, months % 12 + 1, 1) <= stop:
        months += step_months
    months += step_months  # month lengths may shift a start: one window of slack
    return _dt.date(months // 12, months % 12 + 1, 1)


def scan_window(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Rows with ``start <= date < end`` (half-open; pushed to the scan)."""
    d = F.col(date_col)
    return df.where((d >= _date(start)) & (d < _date(end)))


def filter_label_prefix(df: DataFrame, prefix: str | None, col: str = "ipc_label") -> DataFrame:
    """Keep rows whose class label starts with ``prefix``; ``None`` keeps all."""
    if not prefix:
        return df
    return df.where(F.col(col).startswith(prefix))


def split_by_dates(
    df: DataFrame,
    date_col: str,
    train: tuple,
    val: tuple,
    out: str = "split",
) -> DataFrame:
    """S3: label rows ``train`` / ``val`` by two half-open date ranges; drop others."""
    d = F.col(date_col)
    in_train = (d >= _date(train[0])) & (d < _date(train[1]))
    in_val = (d >= _date(val[0])) & (d < _date(val[1]))
    label = F.when(in_train, F.lit("train")).when(in_val, F.lit("val"))
    return df.where(in_train | in_val).withColumn(out, label)
