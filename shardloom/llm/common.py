"""Helpers shared by the operators: staging, row keys, folds, checked broadcast."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.session import scratch_path, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Largest table, in bytes of its values, that is sent to every executor.
BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor's work is read again from files instead of
    being computed again.  An empty result keeps its schema.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(k))


def quoted(name: str) -> str:
    """A column's name as a reference: dots in it are not fields."""
    return "`" + name.replace("`", "``") + "`"


def columns_but(df: DataFrame, outputs: Iterable[str]) -> list[Column]:
    """All columns but those an output replaces; names are compared as Spark does, without case."""
    taken = {o.lower() for o in outputs}
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in taken]


def add_columns(
    df: DataFrame,
    added: Sequence[T.StructField],
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[Sequence[pa.Array], Sequence[pa.Array]]]],
) -> DataFrame:
    """``df`` with the columns ``added``, made in Arrow batches: ``run`` yields pairs
    of df's columns (all rows or some) and the new ones.  Columns go by place, so
    any names will do; those of ``df`` that a new one replaces must be out of it."""
    fields = [*df.schema.fields, *added]
    names = [f"c{i}" for i in range(len(fields))]
    schema = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, fields, strict=True)])

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, more in run(given):
            yield pa.RecordBatch.from_arrays([*kept, *more], names=names)

    plain = df.toDF(*names[: len(df.columns)])
    return plain.mapInArrow(batches, schema).toDF(*(f.name for f in fields))


def row_key(doc_id: Column, text: Column) -> Column:
    """128-bit key of (id, text), null-safe: rows equal in both share it."""
    parts = [F.coalesce(F.concat(F.lit("i"), doc_id.cast("string")), F.lit("n")), F.lit("\x00")]
    parts.append(F.coalesce(F.concat(F.lit("t"), text), F.lit("n")))
    return F.md5(F.concat(*parts))


def broadcast_within(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if the summed ``size`` of its rows is proven to be within
    ``limit`` bytes; else leave it to a shuffled join, which gives the same rows."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def small_batches(batch: pa.RecordBatch, at: int, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices holding at most ``limit`` bytes of the text in column ``at`` (one
    row at least), so that very long texts do not add up in a worker."""
    if batch.num_rows == 0:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = int(sizes[start - 1]) if start else 0
        stop = max(int(np.searchsorted(sizes, before + limit, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
