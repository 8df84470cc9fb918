"""Batches as files that each process streams in order and resumes in the middle.

Layout of an export (a folder that is written once)::

    <path>/batches/rank=<r>/part=<0000000012>/<one Parquet file>
    <path>/index                                  one row a file

The stream of a process (``rank``) is every ``world_size``-th delivered batch; a
batch's ``slot`` is its place there.  A file holds ``per_file`` slots in order, so a
rank's files in name order are its stream, and slot ``s`` is row ``s mod per_file``
of file ``s div per_file``: resuming needs neither a scan nor a sort.

Rank, file and slot of a sample follow from the dealt manifest alone, so samples go
straight to the task that stacks their batch and writes its file: the arrays cross
one exchange.  A file never holds more than ``per_file`` batches, whatever the data.

The index is written last, from what the files hold, and only if they hold every
batch that the manifest promises.  A killed task leaves nothing (the job commits
whole), a driver that dies leaves a folder without an index, and readers refuse a
folder whose index is absent or does not add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shardloom.operators.feed import assign_batches, delivery_order, gather_batches, split_ranks
from shardloom.session import materialize


def placed_samples(samples: DataFrame, counts: DataFrame, batch_size: int, world_size: int, per_file: int) -> DataFrame:
    """Samples with batch, ``delivery``, ``rank``, ``slot`` (place in the rank's
    stream) and ``part`` (its file); ``counts`` is ``feed.worker_batches``."""
    if per_file <= 0:
        raise ValueError("per_file must be positive")
    rows = split_ranks(delivery_order(assign_batches(samples, batch_size), counts), world_size)
    rows = rows.withColumn("slot", F.expr(f"delivery div {int(world_size)}"))
    return rows.withColumn("part", F.format_string("%010d", F.expr(f"slot div {int(per_file)}")))


def write_delivery(samples: DataFrame, counts: DataFrame, path: str, *, batch_size: int, world_size: int, per_file: int = 64) -> DataFrame:
    """Stack ``samples`` (W7, with ids and labels) into batches and write them as
    above; returns the index.  ``path`` must be new."""
    spark = samples.sparkSession
    rows = placed_samples(samples, counts, batch_size, world_size, per_file)
    # Grouping keys contain the exchange's, so stacking needs no second exchange.
    keys = ["rank", "part", "slot", "delivery", "worker", "batch_id"]
    batches = gather_batches(rows.repartition("rank", "part"), keys, sort_by=["rank", "part", "slot"])
    batches.write.partitionBy("rank", "part").parquet(f"{path}/batches")

    total = int(counts.agg(F.sum("n")).first()[0] or 0)
    held = materialize(_files(spark, path).groupBy("rank", "part").agg(
        F.count("*").alias("n_batches"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.min("delivery").alias("first_delivery"),
    ), "delivery-held")  # the files are read once for the check and the index
    index = held.select(
        "rank", "part", "n_batches", "first_slot", "last_slot", "first_delivery",
        F.lit(int(world_size)).alias("world_size"), F.lit(int(per_file)).alias("per_file"), F.lit(total).cast("long").alias("total"),
    )
    _check(index)
    index.write.parquet(f"{path}/index")
    return delivery_index(spark, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/batches")


def _check(index: DataFrame) -> None:
    """Fail unless every slot of every rank is in its file, once: as many rows as
    slots from first to last, files that begin where their number says, and as
    many batches in all as were promised."""
    first = F.col("part").cast("long") * F.col("per_file")
    whole = F.col("n_batches") == F.col("last_slot") - F.col("first_slot") + 1
    placed = (F.col("first_slot") == first) & (F.col("first_delivery") == F.col("first_slot") * F.col("world_size") + F.col("rank"))
    row = index.agg(
        F.sum("n_batches").alias("n"),
        F.max("total").alias("total"),
        F.coalesce(F.sum((~(whole & placed)).cast("long")), F.lit(0)).alias("bad"),
    ).first()
    if row["total"] is None or row["n"] != row["total"] or row["bad"]:
        raise ValueError(f"the export holds {row['n'] or 0} of {row['total']} batches; {row['bad']} files do not hold the slots of their number")


def delivery_index(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: rank, part, n_batches, first_slot, last_slot, first_delivery,
    world_size, per_file, total.  Fails for a folder without a whole index."""
    try:
        index = spark.read.parquet(f"{path}/index")
    except AnalysisException as e:
        raise ValueError(f"{path} holds no finished export: its index is missing") from e
    _check(index)
    return index


def rank_files(spark: SparkSession, path: str, rank: int, first_slot: int = 0) -> DataFrame:
    """Files that hold a rank's stream from ``first_slot`` on, in the order to read
    them (by ``folder``): folder, first_slot, n_batches and ``skip``, the rows to
    leave out at the head of the first one.  A trainer opens these one after another."""
    index = delivery_index(spark, path).where((F.col("rank") == int(rank)) & (F.col("last_slot") >= int(first_slot)))
    name = F.format_string("batches/rank=%d/part=%010d", "rank", F.col("part").cast("long"))
    skip = F.greatest(F.lit(int(first_slot)) - F.col("first_slot"), F.lit(0)).cast("long")
    return index.select(name.alias("folder"), "first_slot", "n_batches", skip.alias("skip")).orderBy("folder")


def read_rank(spark: SparkSession, path: str, rank: int, first_slot: int = 0) -> DataFrame:
    """A rank's batches from ``first_slot`` on, with ``slot``; earlier files and the
    other ranks' are pruned by their folders' names."""
    per_file = delivery_index(spark, path).select("per_file").first()[0]
    mine = (F.col("rank") == int(rank)) & (F.col("part") >= int(first_slot) // per_file)
    return _files(spark, path).where(mine & (F.col("slot") >= int(first_slot)))
