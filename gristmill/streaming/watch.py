"""Early stop and overfit detection of many runs, with the state of each run in Spark's state store."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gristmill.operators.earlystop import usable

RUN = "last_step bigint, best double, waited int, stop_step bigint, open_length bigint, detect_step bigint"
STATE = f"{RUN}, tail binary, waiting binary"
#: A step as it is held: a null loss or validation loss is told apart from NaN by its flag.
STEP = np.dtype([("step", "<i8"), ("loss", "<f8"), ("val", "<f8"), ("has_loss", "?"), ("has_val", "?")])


def _steps(part: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(part), STEP)
    for name in STEP.names:
        out[name] = part[f"_{name}"].to_numpy()
    return out


def _window_means(tail: np.ndarray, ready: np.ndarray, width: int) -> np.ndarray:
    """Mean of the known losses of the last `width` steps at each ready step; NaN where there are none."""
    rows = np.concatenate([tail, ready])
    loss = np.r_[np.zeros(width - 1), np.where(rows["has_loss"], rows["loss"], 0.0)]
    known = np.r_[np.zeros(width - 1), rows["has_loss"].astype(float)]
    view = np.lib.stride_tricks.sliding_window_view
    with np.errstate(invalid="ignore", divide="ignore"):
        return (view(loss, width).sum(axis=1) / view(known, width).sum(axis=1))[len(tail):]


def _streaks(low: np.ndarray, open_length: int) -> np.ndarray:
    """Length of the streak at each step; the first may go on from `open_length` steps before."""
    at = np.arange(1, len(low) + 1)
    broken = np.maximum.accumulate(np.where(low, -open_length, at))
    return np.where(low, at - broken, 0)


def watched_runs(
    log: DataFrame, width: int = 100, eval_interval: int = 1, streak: int = 100, below: float = 1e-5, after_step: int = 500,
    patience: int = 5, min_delta: float = 0.001, overfit_train: float = 0.01, overfit_ratio: float = 10.0,
    time: str | None = None, silence: int = 86_400_000,
) -> DataFrame:
    """`(run_id, last_step, best, waited, stop_step, open_length, detect_step)` of each run that a batch touches.

    `log` is a stream `(run_id, step, loss, val_loss)`; write the result in update mode, the last row of a run holds.
    Steps may come in any order: one waits until all before it are there. A step sent again counts once, rows without
    a step or with one below 1 say nothing, a step with a validation loss whose number `eval_interval` divides is an
    evaluation. A run's state is its row, its last `width - 1` losses and its waiting steps; a batch reads and writes
    those of its own runs only. `time` names a watermarked column: a run leaves the state when the watermark is
    `silence` milliseconds past its latest row, and steps that come later wait for its first one again. The steps of
    a run in one batch go through one task, 26 bytes each, so bound the batch (`maxFilesPerTrigger`); where one run
    fills the stream, `jobs.monitor` spreads it over tasks. Any state store provider will do, RocksDB for many runs.
    """
    def step(key, parts, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last, best, waited, stop, open_length, detect, tail, waiting = (
            state.get if state.exists else (0, None, 0, None, 0, None, b"", b"")
        )
        tail, held, latest = np.frombuffer(tail, STEP), [np.frombuffer(waiting, STEP)], None
        for part in parts:
            held.append(_steps(part))
            if time and part["_at"].notna().any():
                latest = max(int(part["_at"].max()), latest or 0)
        rows = np.concatenate(held)
        rows = rows[rows["step"] > last]
        rows = rows[np.unique(rows["step"], return_index=True)[1]]
        come = int(np.count_nonzero(rows["step"] == last + 1 + np.arange(len(rows))))
        ready, waiting = rows[:come], rows[come:]
        if come:
            means = _window_means(tail, ready, width)
            evaluated = ready["has_val"] & (ready["step"] % eval_interval == 0) & (stop is None)
            fits, extra = usable(ready["val"]), (means < overfit_train) & (ready["val"] > means * overfit_ratio)
            for i in np.flatnonzero(evaluated):
                val = float(ready["val"][i])
                better = fits[i] and (best is None or best - val > min_delta)
                best, waited = (val, 0) if better else (best, waited + 1)
                waited += int(extra[i])
                if waited >= patience:
                    stop = int(ready["step"][i])
                    break
            lengths = _streaks((means < below) & (ready["step"] > after_step), open_length)
            long = np.flatnonzero(lengths >= streak)
            if detect is None and len(long):
                detect = int(ready["step"][long[0]])
            last, open_length = last + come, int(lengths[-1])
            both = np.concatenate([tail, ready])
            tail = both[max(0, len(both) - (width - 1)):]
        row = (last, best, waited, stop, open_length, detect)
        state.update((*row, tail.tobytes(), waiting.tobytes()))
        if time:
            watermark = state.getCurrentWatermarkMs()
            state.setTimeoutTimestamp(max((latest or watermark) + silence, watermark + 1))
        yield pd.DataFrame({"run_id": [key[0]]} | {f.split()[0]: pd.Series([v], dtype=object) for f, v in zip(RUN.split(", "), row)})

    plain = log.filter("step > 0").select(
        "run_id", F.col("step").cast("bigint").alias("_step"),
        F.coalesce(F.col("loss").cast("double"), F.lit(0.0)).alias("_loss"),
        F.coalesce(F.col("val_loss").cast("double"), F.lit(0.0)).alias("_val"),
        F.col("loss").isNotNull().alias("_has_loss"), F.col("val_loss").isNotNull().alias("_has_val"),
        *([F.col(time), F.unix_millis(F.col(time).cast("timestamp")).alias("_at")] if time else []),
    )
    kind = log.schema["run_id"].dataType.simpleString()
    return plain.groupBy("run_id").applyInPandasWithState(
        step, f"run_id {kind}, {RUN}", STATE, "update",
        GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout,
    )
