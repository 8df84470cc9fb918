"""Log windows kept up to date: new slices of a training log are folded in.

``fold`` reads the new slice only.  It keeps, under one folder:

* ``open``: a partial state per (rank, epoch, optimizer step) of the windows that
  are not full yet: loss sum, micro-steps, an odd loss seen, last step and time;
* ``epochs``: steps and start of every (rank, epoch), which is also the watermark:
  a rank's log arrives in (epoch, step) order, so its last step says what is in;
* ``windows``: the rows of the windows that this fold completed.

Partial states merge by sums (exact decimals), maxima and minima, so slices of any
size give the rows of ``trainlog.loss_windows`` over the whole log.  A window is
full once every one of the ``n_ranks`` processes has completed its last optimizer step;
a step cut short by the end of its epoch is complete when the rank's next
epoch has begun, or with ``finish``.  What is open is bounded by the distance between the
fastest and the slowest rank, not by the log.

Each fold writes its tables to a folder of its own number; one row appended to
``done`` makes it count.  A fold that dies before leaves no trace that readers see, and
the same slice can be folded again; a slice that is in already fails, by the
watermark.  One writer at a time a folder.

Edge cases: an empty slice is folded as nothing new; a null rank, epoch, step or ts,
a rank outside 0..n_ranks-1 and steps at or before the watermark fail; a loss
that is null or not finite makes its window's mean and perplexity NaN.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shardloom.operators.ordering import broadcast_if_small
from shardloom.operators.trainlog import LOSS_DECIMAL, window_rows

@dataclass(frozen=True)
class FoldRule:
    accum: int
    update_freq: int
    tokens_per_step: int
    n_ranks: int
    main_rank: int = 0

    def __post_init__(self):
        if min(self.accum, self.update_freq, self.n_ranks) <= 0:
            raise ValueError("accum, update_freq and n_ranks must be positive")


def _last(spark: SparkSession, path: str):
    """The newest fold that counts, or None."""
    try:
        return spark.read.parquet(f"{path}/done").orderBy(F.desc("version")).first()
    except AnalysisException:
        return None


def _folder(path: str, version: int, table: str) -> str:
    return f"{path}/{table}/version={version:010d}"


def _partials(log: DataFrame, accum: int) -> DataFrame:
    odd = F.coalesce(F.isnan("loss") | (F.abs("loss") == float("inf")), F.lit(True)).cast("int")
    return log.groupBy("rank", "epoch", F.expr(f"cast(step div {accum} as long)").alias("sync")).agg(
        F.sum(F.col("loss").cast(LOSS_DECIMAL)).alias("loss_sum"),
        F.count("*").alias("micro_steps"),
        F.max(odd).alias("odd"),
        F.max(F.struct(F.col("step").cast("long").alias("last_step"), F.col("ts").alias("last_ts"))).alias("last"),
    ).select("rank", "epoch", "sync", "loss_sum", "micro_steps", "odd", "last.last_step", "last.last_ts")


def _merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("rank", "epoch", "sync").agg(
        F.sum("loss_sum").cast(LOSS_DECIMAL).alias("loss_sum"),
        F.sum("micro_steps").alias("micro_steps"),
        F.max("odd").alias("odd"),
        F.max(F.struct("last_step", "last_ts")).alias("last"),
    ).select("rank", "epoch", "sync", "loss_sum", "micro_steps", "odd", "last.last_step", "last.last_ts")


def _epochs(log: DataFrame) -> DataFrame:
    return log.groupBy("rank", "epoch").agg(
        (F.max("step") + 1).cast("long").alias("n_steps"), F.min("ts").alias("epoch_start"), F.min("step").cast("long").alias("first_step")
    )


def _check(log: DataFrame, new: DataFrame, old: DataFrame | None, n_ranks: int) -> None:
    null = F.col("rank").isNull() | F.col("epoch").isNull() | F.col("step").isNull() | F.col("ts").isNull()
    if log.where(null).limit(1).count():
        raise ValueError("a log row has no rank, epoch, step or ts")
    strange = new.where((F.col("rank") < 0) | (F.col("rank") >= n_ranks)).first()
    if strange:
        raise ValueError(f"rank {strange['rank']} is not among {n_ranks} ranks")
    if old is not None:
        seen = old.groupBy("rank").agg(F.max(F.struct("epoch", (F.col("n_steps") - 1).alias("step"))).alias("seen"))
        first = new.groupBy("rank").agg(F.min(F.struct("epoch", F.col("first_step").alias("step"))).alias("first"))
        late = first.join(seen, "rank").where(F.col("first") <= F.col("seen")).first()
        if late:
            raise ValueError(f"rank {late['rank']} has a row at {tuple(late['first'])}, but is in up to {tuple(late['seen'])}")


def fold(log: DataFrame, path: str, rule: FoldRule, *, finish: bool = False) -> DataFrame:
    """Fold a slice (rank, epoch, step, loss, ts) into the folder ``path``; returns the
    rows of the windows it completed.  ``finish``: the log ends here."""
    spark, last = log.sparkSession, _last(log.sparkSession, path)
    version = last["version"] + 1 if last else 1
    start = last["next_window"] if last else 0
    old = spark.read.parquet(_folder(path, version - 1, "epochs")) if last else None

    new = _partials(log, rule.accum)
    fresh = _epochs(log)
    fresh.write.mode("overwrite").parquet(_folder(path, version, "slice"))  # a row a rank and epoch
    fresh = spark.read.parquet(_folder(path, version, "slice"))
    _check(log, fresh, old, rule.n_ranks)

    both = fresh.drop("first_step") if old is None else old.unionByName(fresh.drop("first_step"))
    both = both.groupBy("rank", "epoch").agg(F.max("n_steps").alias("n_steps"), F.min("epoch_start").alias("epoch_start"))
    both.write.mode("overwrite").parquet(_folder(path, version, "epochs"))
    epochs = spark.read.parquet(_folder(path, version, "epochs"))
    steps = F.col("n_steps").cast("long")
    syncs = F.expr(f"(n_steps + {rule.accum - 1}) div {rule.accum}")
    by_epoch = Window.partitionBy("rank").orderBy("epoch")  # a row a rank and epoch
    table = epochs.select("*", syncs.alias("syncs")).withColumn(
        "prior_syncs", F.coalesce(F.sum("syncs").over(by_epoch.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    )
    ended = F.lit(True) if finish else F.lead("epoch").over(by_epoch).isNotNull()
    complete = F.col("prior_syncs") + F.when(ended, F.col("syncs")).otherwise(F.floor(steps / rule.accum))
    ranks = table.withColumn("complete", complete).groupBy("rank").agg(F.max("complete").alias("complete"))
    reached = ranks.agg(F.count("*").alias("ranks"), F.min("complete").alias("complete")).first()
    stop = int(reached["complete"]) // rule.update_freq if reached["ranks"] == rule.n_ranks else 0

    states = new
    if last:
        states = _merged(spark.read.parquet(_folder(path, version - 1, "open")).unionByName(new))
    window = F.expr(f"(prior_syncs + sync) div {rule.update_freq}").alias("log_window")
    states = states.join(broadcast_if_small(table.select("rank", "epoch", "prior_syncs")), ["rank", "epoch"])
    states = states.select(*[c for c in states.columns if c != "prior_syncs"], window)
    states.write.mode("overwrite").parquet(_folder(path, version, "states"))
    states = spark.read.parquet(_folder(path, version, "states"))
    states.where(F.col("log_window") >= stop).drop("log_window").write.mode("overwrite").parquet(_folder(path, version, "open"))

    full = states.where(F.col("log_window") < stop)
    per_rank = full.groupBy("log_window", "rank").agg(
        F.sum("loss_sum").cast(LOSS_DECIMAL).alias("loss_sum"),
        F.sum("micro_steps").alias("micro_steps"),
        F.max("odd").alias("odd"),
        F.max(F.struct("epoch", F.col("last_step").alias("step"), F.col("last_ts").alias("ts"))).alias("last"),
        F.min("epoch").alias("first_epoch"),
    )
    per_rank = per_rank.withColumn("last_sync", (F.col("log_window") + 1) * rule.update_freq)
    before = None
    if last and last["log_ts"] is not None:
        before = spark.range(1).select(F.lit(start - 1).cast("long").alias("log_window"), F.lit(last["log_ts"]).alias("log_ts"))
    rows = window_rows(per_rank, epochs, rule.update_freq, rule.tokens_per_step, rule.n_ranks, rule.main_rank, before=before)
    rows.write.mode("overwrite").parquet(_folder(path, version, "windows"))

    logged = per_rank.where((F.col("rank") == rule.main_rank) & (F.col("log_window") == stop - 1)).select("last.ts").first()
    log_ts = logged["ts"] if logged else (last["log_ts"] if last else None)
    done = spark.createDataFrame([(version, max(stop, start), log_ts)], "version long, next_window long, log_ts timestamp")
    done.coalesce(1).write.mode("append").parquet(f"{path}/done")
    return spark.read.parquet(_folder(path, version, "windows"))


def folded_windows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all windows completed so far."""
    last = _last(spark, path)
    if last is None:
        raise ValueError(f"{path} holds no folded log")
    return spark.read.parquet(*(_folder(path, v, "windows") for v in range(1, last["version"] + 1)))
