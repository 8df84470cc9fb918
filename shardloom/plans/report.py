"""Training-log report (the train-and-log entry point, re-aimed at a table).

A per-micro-step log ``(rank, epoch, step, loss, ts)`` and the run
configuration give: the epoch plan, the log windows (mean loss, perplexity,
throughput), the progress lines and the demo cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.operators import trainlog
from shardloom.session import materialize


@dataclass(frozen=True)
class LogSpec:
    accum: int
    update_freq: int
    seq_len: int
    procs: int
    micro_batch: int
    demo_steps: int | None = None

    @property
    def tokens_per_micro_step(self) -> int:
        return self.seq_len * self.procs * self.micro_batch


def log_report(log: DataFrame, spec: LogSpec) -> dict[str, DataFrame]:
    epochs = materialize(trainlog.epoch_table(log, spec.accum), "epochs")
    loader_len = epochs.agg(F.max("n_steps")).first()[0] or 0
    out = {
        "windows": trainlog.loss_windows(
            log, spec.accum, spec.update_freq, spec.tokens_per_micro_step, epochs=epochs
        ),
        "progress": trainlog.progress_rows(log, spec.tokens_per_micro_step, int(loader_len), accum=spec.accum),
        "steps": trainlog.assign_steps(log, spec.accum, spec.update_freq, epochs=epochs),
    }
    if spec.demo_steps is not None:
        out["demo"] = trainlog.demo_cut(log, spec.accum, spec.demo_steps, epochs=epochs)
    return out
