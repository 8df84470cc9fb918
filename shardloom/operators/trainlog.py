"""Training-log rollups (G5-G10) over a per-micro-step log table
``(rank, epoch, step, loss, ts)``.

Optimizer steps: within an epoch a rank syncs after every ``accum``
micro-steps and at the epoch's last micro-step; the step counter runs on
across epochs.  A log row is written when the global step reaches a multiple
of ``update_freq``; unfinished windows carry over the epoch end.

All per-row work is arithmetic against a tiny ``(rank, epoch)`` table (sizes
and start times), so no rank's rows go to one task.  Window-level results
are a second aggregation of ``(rank, window)`` partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.ordering import broadcast_if_small
from shardloom.session import materialize

# --- fixed values ------------------------------------------------------------
#: Mean loss is clamped here before ``exp`` (perplexity).
PERPLEXITY_CLAMP = 20.0
#: Progress lines are written every this many micro-steps (step > 0).
PROGRESS_EVERY = 50
# ---------------------------------------------------------------------------

#: Loss sums are accumulated exactly in this type.
LOSS_DECIMAL = "decimal(38,12)"


def _check(accum: int, update_freq: int | None = None) -> None:
    if accum <= 0:
        raise ValueError("accum must be positive")
    if update_freq is not None and update_freq <= 0:
        raise ValueError("update_freq must be positive (0 would divide by zero)")


def epoch_table(log: DataFrame, accum: int) -> DataFrame:
    """(rank, epoch, n_steps, epoch_start, syncs, prior_syncs): one row per
    rank and epoch."""
    _check(accum)
    per = log.groupBy("rank", "epoch").agg(
        (F.max("step") + 1).cast("long").alias("n_steps"), F.min("ts").alias("epoch_start")
    )
    per = per.withColumn("syncs", F.expr(f"(n_steps + {accum} - 1) div {accum}"))
    w = Window.partitionBy("rank").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("prior_syncs", F.coalesce(F.sum("syncs").over(w), F.lit(0)).cast("long"))


def assign_steps(log: DataFrame, accum: int, update_freq: int, *, epochs: DataFrame | None = None) -> DataFrame:
    """Per micro-step ``opt_step`` (1-based optimizer step it feeds),
    ``is_sync`` and ``log_window = (opt_step - 1) div update_freq``.
    ``epochs`` is the log's ``epoch_table`` where the caller has it."""
    _check(accum, update_freq)
    ep = epochs if epochs is not None else epoch_table(log, accum)
    j = log.join(broadcast_if_small(ep.select("rank", "epoch", "n_steps", "prior_syncs", "epoch_start")), ["rank", "epoch"])
    return j.select(
        *log.columns,
        "epoch_start",
        (F.col("prior_syncs") + F.expr(f"step div {accum}") + 1).cast("long").alias("opt_step"),
        (((F.col("step") + 1) % accum == 0) | (F.col("step") == F.col("n_steps") - 1)).alias("is_sync"),
    ).withColumn("log_window", F.expr(f"(opt_step - 1) div {update_freq}"))


def demo_cut(log: DataFrame, accum: int, n_demo_steps: int, *, epochs: DataFrame | None = None) -> DataFrame:
    """Micro-steps processed in demo mode: those that start while the
    global step is ``<= n_demo_steps`` (so ``n_demo_steps + 1`` optimizer
    steps run; later epochs process nothing)."""
    steps = assign_steps(log, accum, 1, epochs=epochs)
    return steps.where(F.col("opt_step") - 1 <= F.lit(int(n_demo_steps))).drop("epoch_start", "log_window")


def loss_windows(
    log: DataFrame,
    accum: int,
    update_freq: int,
    tokens_per_step: int,
    main_rank: int = 0,
    *,
    epochs: DataFrame | None = None,
) -> DataFrame:
    """One row per full log window.

    The log is read twice: for the epoch table and for one rollup to
    ``(log_window, rank)``; both are written and all else comes from them.

    * ``mean_loss`` = (sum of losses over all ranks) / (micro-steps of the
      main rank) / ranks, as the cross-rank reduce does;
    * ``perplexity`` = ``exp(min(mean_loss, 20))``; one loss of a window that is null or
      not finite makes both NaN (``loss_sum`` adds the others);
    * ``tokens_per_sec`` = tokens_per_step x micro-steps / elapsed, elapsed
      from the previous log (or the epoch start, whichever is later) to this
      log, on the main rank; 0 when elapsed <= 0.  A window spanning an epoch
      end is flagged (its elapsed time restarts at the epoch).
    """
    if epochs is None:
        epochs = materialize(epoch_table(log, accum), "epochs")
    steps = assign_steps(log, accum, update_freq, epochs=epochs)
    n_ranks = int(epochs.select(F.countDistinct("rank").alias("n")).first()["n"] or 1)

    # Exact decimal sums: the window mean does not depend on partitioning.
    per_rank = steps.groupBy("log_window", "rank").agg(
        F.sum(F.col("loss").cast(LOSS_DECIMAL)).alias("loss_sum"),
        F.count("*").alias("micro_steps"),
        F.max(F.coalesce(F.isnan("loss") | (F.abs("loss") == float("inf")), F.lit(True)).cast("int")).alias("odd"),
        F.max(F.struct("epoch", "step", "ts")).alias("last"),
        F.min("epoch").alias("first_epoch"),
        F.max(F.when(F.col("is_sync"), F.col("opt_step"))).alias("last_sync"),
    )
    per_rank = materialize(per_rank, "log-windows-by-rank")
    return window_rows(per_rank, epochs, update_freq, tokens_per_step, n_ranks, main_rank)


def window_rows(
    per_rank: DataFrame,
    epochs: DataFrame,
    update_freq: int,
    tokens_per_step: int,
    n_ranks: int,
    main_rank: int = 0,
    *,
    before: DataFrame | None = None,
) -> DataFrame:
    """Rows of the full windows from a rollup per (log_window, rank).  ``before``:
    (log_window, log_ts) of the main rank for windows that the rollup does not hold."""
    main = per_rank.where(F.col("rank") == main_rank).select(
        "log_window",
        F.col("micro_steps").alias("main_steps"),
        F.col("last.epoch").alias("epoch"),
        F.col("last.step").alias("end_step"),
        F.col("last.ts").alias("log_ts"),
        (F.col("first_epoch") != F.col("last.epoch")).alias("spans_epoch"),
    )
    totals = per_rank.groupBy("log_window").agg(
        F.sum("loss_sum").alias("loss_sum"),
        F.min("last_sync").alias("last_sync"),
        F.count("*").alias("ranks"),
        F.max("odd").alias("odd"),
    )
    # A window is full once every rank has reached its last sync.
    reached = F.col("last_sync") == (F.col("log_window") + 1) * update_freq
    full = totals.where(reached & (F.col("ranks") == n_ranks)).drop("ranks")
    win = full.join(main, "log_window")

    starts = epochs.where(F.col("rank") == main_rank).select("epoch", "epoch_start")
    logged = main.select("log_window", "log_ts")
    logged = logged if before is None else logged.unionByName(before)
    prev = logged.select((F.col("log_window") + 1).alias("log_window"), F.col("log_ts").alias("prev_ts"))
    win = win.join(broadcast_if_small(starts), "epoch").join(prev, "log_window", "left")
    since = F.greatest(F.coalesce(F.col("prev_ts"), F.col("epoch_start")), F.col("epoch_start"))
    elapsed = F.timestamp_diff("MICROSECOND", since, F.col("log_ts")) / 1e6
    finite = (F.col("loss_sum") / F.col("main_steps") / F.lit(n_ranks)).cast("double")
    nan = F.lit(float("nan"))  # one loss that is not finite spoils the window's mean, as in a plain sum
    mean_loss = F.when(F.col("odd") == 1, nan).otherwise(finite)
    return win.select(
        "log_window",
        "epoch",
        "end_step",
        ((F.col("log_window") + 1) * update_freq).cast("long").alias("global_step"),
        F.col("loss_sum").cast(LOSS_DECIMAL).alias("loss_sum"),
        F.lit(n_ranks).cast("long").alias("n_ranks"),
        mean_loss.alias("mean_loss"),
        F.when(F.col("odd") == 1, nan).otherwise(F.exp(F.least(finite, F.lit(PERPLEXITY_CLAMP)))).alias("perplexity"),
        elapsed.alias("elapsed_sec"),
        F.when(elapsed > 0, F.lit(float(tokens_per_step)) * F.col("main_steps") / elapsed)
        .otherwise(F.lit(0.0))
        .alias("tokens_per_sec"),
        F.col("main_steps").cast("long").alias("micro_steps"),
        "spans_epoch",
    )


def progress_rows(log: DataFrame, tokens_per_step: int, loader_len: int, accum: int | None = None) -> DataFrame:
    """Every 50th micro-step (step > 0) of each rank and epoch: tokens
    processed in the epoch, share of the epoch in percent (4 decimals) and
    elapsed time since the epoch start as ``HH:MM:SS.ss``.  With ``accum``,
    also the global optimizer step at that point (syncs completed before it)."""
    if accum is not None:
        per = epoch_table(log, accum).select("rank", "epoch", "epoch_start", "prior_syncs")
    else:
        per = log.groupBy("rank", "epoch").agg(F.min("ts").alias("epoch_start"))
    rows = log.where((F.col("step") % PROGRESS_EVERY == 0) & (F.col("step") > 0))
    rows = rows.join(broadcast_if_small(per), ["rank", "epoch"])
    t = F.timestamp_diff("MICROSECOND", F.col("epoch_start"), F.col("ts")) / 1e6
    processed = (F.col("step") + 1).cast("long") * F.lit(int(tokens_per_step))
    total = int(tokens_per_step) * int(loader_len)
    cols = [
        "rank",
        "epoch",
        "step",
        processed.alias("processed_tokens"),
        F.lit(total).cast("long").alias("epoch_tokens"),
        F.round(processed * 100.0 / F.lit(total), 4).alias("pct"),
        F.format_string(
            "%02d:%02d:%05.2f",
            F.floor(t / 3600).cast("int"),
            F.floor((t % 3600) / 60).cast("int"),
            t % 60,
        ).alias("elapsed"),
    ]
    if accum is not None:
        cols.append((F.col("prior_syncs") + F.expr(f"step div {int(accum)}")).cast("long").alias("global_step"))
    return rows.select(*cols)
