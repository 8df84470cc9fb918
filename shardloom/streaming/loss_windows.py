"""Log windows computed online from a stream of training-log rows.

The training loop logs a window as soon as its last optimizer step is done.
Here the per-micro-step log ``(rank, epoch, step, loss, ts)`` arrives as a
stream (files appended to a folder while training runs); each row's window is
pure arithmetic when the epoch length is known (it is: the loader length), so
rows are keyed by ``log_window`` and a small per-window state collects loss
sums and micro-step counts per rank.  A window is emitted (append mode) once
every rank has delivered all its micro-steps, and its state is dropped, so
state holds only the windows in flight.

Loss sums are exact decimals, so the streamed rows equal the batch rollup
(``operators.trainlog.loss_windows``) for every finished window.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from shardloom.operators.trainlog import LOSS_DECIMAL
from shardloom.session import ship_package

OUTPUT_SCHEMA = (
    "log_window long, epoch int, end_step int, global_step long, loss_sum string, "
    "micro_steps long, n_ranks long, spans_epoch boolean, mean_loss double, log_ts {ts}"
)
STATE_SCHEMA = "sums string, counts string, first_epoch int, last_epoch int, last_step int, last_ts {ts}"


def window_size(w: int, steps_per_epoch: int, n_epochs: int, accum: int, update_freq: int) -> int | None:
    """Micro-steps per rank in full log window ``w`` (``None`` if the run ends
    before the window is full).  Closed form: every optimizer step takes
    ``accum`` micro-steps except an epoch's last, which takes the remainder."""
    syncs = -(-steps_per_epoch // accum)
    if w < 0 or (w + 1) * update_freq > n_epochs * syncs:
        return None
    last = steps_per_epoch - accum * (syncs - 1)
    epoch_ends = (w + 1) * update_freq // syncs - w * update_freq // syncs
    return update_freq * accum - epoch_ends * (accum - last)


def with_windows(log: DataFrame, steps_per_epoch: int, accum: int, update_freq: int) -> DataFrame:
    syncs = -(-steps_per_epoch // accum)
    opt = F.col("epoch").cast("long") * syncs + F.expr(f"step div {accum}") + 1
    return log.withColumn("opt_step", opt).withColumn("log_window", F.expr(f"(opt_step - 1) div {update_freq}"))


def stream_loss_windows(
    log_stream: DataFrame,
    *,
    steps_per_epoch: int,
    n_epochs: int,
    accum: int,
    update_freq: int,
    n_ranks: int,
    main_rank: int = 0,
) -> DataFrame:
    """Streaming DataFrame of finished log windows (append mode)."""
    if update_freq <= 0 or accum <= 0:
        raise ValueError("accum and update_freq must be positive")
    ship_package(log_stream.sparkSession)
    rows = with_windows(log_stream, steps_per_epoch, accum, update_freq).select(
        "log_window", "rank", "epoch", "step", F.col("loss").cast(LOSS_DECIMAL).cast("string").alias("loss"), "ts"
    )

    def update(key, batches, state):
        import pandas as pd

        w = int(key[0])
        if state.exists:
            s = state.get
            sums = {int(k): Decimal(v) for k, v in (p.split("=") for p in s[0].split(";") if p)}
            counts = {int(k): int(v) for k, v in (p.split("=") for p in s[1].split(";") if p)}
            first_epoch, last = s[2], (s[3], s[4], s[5])
        else:
            sums, counts, first_epoch, last = {}, {}, None, (None, None, None)
        for pdf in batches:
            for r, grp in pdf.groupby("rank"):
                r = int(r)
                sums[r] = sums.get(r, Decimal(0)) + sum((Decimal(x) for x in grp["loss"]), Decimal(0))
                counts[r] = counts.get(r, 0) + len(grp)
                if r == main_rank:
                    e_min = int(grp["epoch"].min())
                    first_epoch = e_min if first_epoch is None else min(first_epoch, e_min)
                    top = grp.sort_values(["epoch", "step"]).iloc[-1]
                    cand = (int(top["epoch"]), int(top["step"]), top["ts"])
                    if last[0] is None or cand[:2] > (last[0], last[1]):
                        last = cand
        need = window_size(w, steps_per_epoch, n_epochs, accum, update_freq)
        done = need is not None and len(counts) == n_ranks and all(c == need for c in counts.values())
        if not done:
            state.update(
                (
                    ";".join(f"{k}={v}" for k, v in sums.items()),
                    ";".join(f"{k}={v}" for k, v in counts.items()),
                    first_epoch,
                    last[0],
                    last[1],
                    last[2],
                )
            )
            return
        state.remove()
        total = sum(sums.values(), Decimal(0)).quantize(Decimal("1e-12"))
        main_steps = counts[main_rank]
        yield pd.DataFrame(
            {
                "log_window": [w],
                "epoch": [last[0]],
                "end_step": [last[1]],
                "global_step": [(w + 1) * update_freq],
                "loss_sum": [format(total, "f")],
                "micro_steps": [main_steps],
                "n_ranks": [n_ranks],
                "spans_epoch": [first_epoch != last[0]],
                "mean_loss": [float(total / main_steps / n_ranks)],
                "log_ts": [last[2]],
            }
        )

    ts_type = log_stream.schema["ts"].dataType.simpleString()  # timestamp or timestamp_ntz
    return rows.groupBy("log_window").applyInPandasWithState(
        update, OUTPUT_SCHEMA.format(ts=ts_type), STATE_SCHEMA.format(ts=ts_type), "append", GroupStateTimeout.NoTimeout
    )


def run_to_table(stream_df: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Drive the stream over everything available into Parquet and read it back."""
    q = (
        stream_df.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return stream_df.sparkSession.read.parquet(out_path)
