"""Early stopping of runs of any length: a block of evaluations is a table of what it does to the state that enters it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def overfits(val: Column, train: Column, low: float, ratio: float) -> Column:
    """1 where the training loss is low and the validation loss far above it, else 0."""
    return F.coalesce((train < low) & (val > train * ratio) & ~F.isnan(val), F.lit(False)).cast("int")


def usable(val: np.ndarray) -> np.ndarray:
    return ~np.isnan(val) & (val < np.inf)


def outcomes(group: np.ndarray, val: np.ndarray, extra: np.ndarray, patience: int, delta: float):
    """What becomes of each evaluation if it is a new best: `(goes, waited, stops)`.

    `goes` is the place of the best at the end of its group, `waited` the count there, `stops` the place where the
    group's patience ends, or -1. Every evaluation without improvement adds one or more to the count, so the next
    best or the stop lies at most `patience` rows ahead; the chain of bests is then followed by doubling.
    """
    n = len(val)
    at = np.arange(n)
    goes, waited = at.copy(), extra.astype(np.int64)
    stops = np.where(waited >= patience, at, -1)
    pending = stops < 0
    fits = usable(val)
    for ahead in range(1, min(patience, n - 1) + 1):
        here = at[:n - ahead][pending[:n - ahead] & (group[:n - ahead] == group[ahead:])]
        if not len(here):
            break
        there = here + ahead
        with np.errstate(invalid="ignore"):
            better = fits[there] & (val[here] - val[there] > delta)
        goes[here[better]] = there[better]
        worse, seen = here[~better], there[~better]
        waited[worse] += 1 + extra[seen]
        full = waited[worse] >= patience
        stops[worse[full]] = seen[full]
        pending[here[better]] = False
        pending[worse[full]] = False
    while True:
        further = goes[goes]
        if np.array_equal(further, goes):
            return goes, waited[goes], stops[goes]
        goes = further


def _heads(patience: int, delta: float):
    """Sorted evaluations -> the first `patience` ones of each block, each with what it leads to as a new best.

    A block may span Arrow batches: its rows are held until the next block begins, at most one block at a time.
    """
    def told(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        val = rows["_val"].to_numpy(float, na_value=np.nan)
        extra = rows["_extra"].to_numpy(np.int64)
        step = rows["step"].to_numpy(np.int64)
        goes, waited, stops = outcomes(group, val, extra, patience, delta)
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
        head = place < patience
        out = rows.loc[head, ["run_id", "_b", "step", "_val", "_extra"]].copy()
        out["_best"], out["_waited"] = val[goes][head], waited[head].astype(np.int32)
        out["_stop"] = pd.array(np.where(stops[head] < 0, 0, step[stops[head]]), dtype="Int64")
        out.loc[stops[head] < 0, "_stop"] = pd.NA
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            rows = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
            runs = pd.factorize(rows["run_id"], use_na_sentinel=False)[0]
            block = rows["_b"].to_numpy(np.int64)
            new = np.r_[False, (runs[1:] != runs[:-1]) | (block[1:] != block[:-1])]
            group = np.cumsum(new)
            last = int(np.searchsorted(group, group[-1]))
            if last:
                yield told(rows.iloc[:last], group[:last])
            held = [rows.iloc[last:]]
        if held:
            yield told(held[0].reset_index(drop=True), np.zeros(len(held[0]), np.int64))

    return run


def _through(heads: Column, start: Column, patience: int, delta: float) -> Column:
    """The state after a run's blocks: in each one, only the evaluations up to the first new best are looked at."""
    def step(acc: Column, e: Column) -> Column:
        fits = F.coalesce(~F.isnan(e["_val"]) & (e["_val"] < float("inf")), F.lit(False))
        better = fits & (acc["best"].isNull() | (acc["best"] - e["_val"] > delta))
        waited = acc["waited"] + 1 + e["_extra"]
        jumped = F.struct(
            e["_best"].alias("best"), e["_waited"].alias("waited"), e["_stop"].alias("stop_step"), e["_b"].alias("_done")
        )
        walked = F.struct(
            acc["best"].alias("best"), waited.alias("waited"), F.when(waited >= patience, e["step"]).alias("stop_step"),
            acc["_done"].alias("_done"),
        )
        settled = acc["stop_step"].isNotNull() | F.coalesce(acc["_done"] == e["_b"], F.lit(False))
        return F.when(settled, acc).when(better, jumped).otherwise(walked)

    return F.aggregate(heads, start, step)


def early_stop(
    evals: DataFrame, patience: int = 5, min_delta: float = 0.001, overfit_train: float = 0.01,
    overfit_ratio: float = 10.0, state: DataFrame | None = None, block_evals: int = 50_000,
) -> DataFrame:
    """`(run_id, best, waited, stop_step)` over `(run_id, eval_no, step, val_loss, train_loss)`.

    The rule depends on the order of a run's evaluations, but what a block of them does to the state is settled by
    the first `patience` rows: one of them is a new best, from which on the entry no longer matters, or the run stops
    there. All blocks find their tables side by side, at most `block_evals` rows of a run in one piece, and a run's
    state goes through `patience` rows a block. One job, however long the run. A null loss never improves.
    `state` is what an earlier call returned.
    """
    rows = evals.select(
        "run_id", F.floor((F.col("eval_no") - 1) / block_evals).cast("bigint").alias("_b"), F.col("step").cast("bigint").alias("step"),
        F.col("val_loss").cast("double").alias("_val"),
        overfits(F.col("val_loss"), F.col("train_loss"), overfit_train, overfit_ratio).alias("_extra"),
    )
    schema = StructType([
        *(StructField(f.name, f.dataType) for f in rows.schema.fields), StructField("_best", DoubleType()), StructField("_waited", IntegerType()), StructField("_stop", LongType()),
    ])
    heads = rows.repartition("run_id", "_b").sortWithinPartitions("run_id", "_b", "step").mapInPandas(
        _heads(patience, min_delta), schema
    )
    lists = heads.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("_b", "step", "_val", "_extra", "_best", "_waited", "_stop"))).alias("_e")
    )
    fresh = F.struct(
        F.lit(None).cast("double").alias("best"), F.lit(0).alias("waited"), F.lit(None).cast("bigint").alias("stop_step"),
        F.lit(None).cast("bigint").alias("_done"),
    )
    if state is None:
        both = lists.withColumn("_s", fresh)
    else:
        known = state.select("run_id", F.struct("best", "waited", "stop_step", F.lit(None).cast("bigint").alias("_done")).alias("_s"))
        both = lists.join(known, "run_id", "full").select(
            "run_id", F.coalesce("_s", fresh).alias("_s"),
            F.coalesce("_e", F.array().cast(lists.schema["_e"].dataType)).alias("_e"),
        )
    after = _through(F.col("_e"), F.col("_s"), patience, min_delta)
    return both.select("run_id", after.alias("_s")).select("run_id", "_s.best", "_s.waited", "_s.stop_step")
