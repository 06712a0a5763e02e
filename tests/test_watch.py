"""Runs watched with state per key, runs closed by silence, and early stopping by blocks."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import metrics
from gristmill.operators.earlystop import outcomes
from gristmill.streaming import jobs, watch
from gristmill.streaming.sinks import drain, latest

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    yield spark
    spark.conf.set(name, before)


def watched(spark, tmp_path, batches, schema=jobs.STEP_ROWS, **options):
    """Rows after each batch, and what Spark says of the state."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    if "time" in options:
        stream = stream.withWatermark("at", "1 second")
    out = str(tmp_path / "out")
    query = (
        watch.watched_runs(stream, **options).writeStream.outputMode("update")
        .foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch_id={n}"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return out, [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]


def steps(seed, runs=4, n=160):
    rng = random.Random(seed)
    low = [0.001, 0.9], [0.001, 0.002]
    return [
        (f"r{r}", s, rng.choice([*low[s >= 60], None]), rng.choice([rng.uniform(0, 2), float("nan")]) if s % 10 == 0 else None)
        for r in range(runs) for s in range(1, n + 1)
    ]


@pytest.mark.parametrize("seed", [3, 4])
def test_watched_runs_equal_batch(rocks, tmp_path, seed):
    spark, rows = rocks, steps(seed)
    rules = dict(patience=4, overfit_train=0.3, overfit_ratio=2.0)
    shuffled = rows + rows[::7] + [("r0", None, 1.0, 1.0), ("r0", 0, 1.0, 1.0)]
    random.Random(seed).shuffle(shuffled)
    out, _ = watched(
        spark, tmp_path, [shuffled[i::3] for i in range(3)], width=20, eval_interval=10, streak=15, below=0.1, after_step=30, **rules
    )
    got = {r.run_id: (r.last_step, r.best, r.waited, r.stop_step, r.detect_step) for r in latest(spark, out, ["run_id"]).collect()}

    means = metrics.smoothed_loss(spark.createDataFrame(rows, jobs.STEP_ROWS), 20)
    evals = means.filter("val_loss is not null").select(
        "run_id", (F.col("step") / 10).cast("bigint").alias("eval_no"), "step", "val_loss", F.col("avg_loss").alias("train_loss")
    )
    stops = {r.run_id: (r.best, r.waited, r.stop_step) for r in metrics.early_stop(evals, **rules).collect()}
    found = {r.run_id: r.detect_step for r in metrics.overfit_stop(metrics.overfit_streaks(means, 0.1, 30), 15).collect()}
    assert got == {r: (160, *stops[r], found.get(r)) for r in stops}


def test_a_batch_writes_the_state_of_its_own_runs(rocks, tmp_path):
    batches = [[(f"r{r}", 1, 1.0, None) for r in range(30)]] + [[("r7", s, 1.0, None)] for s in range(2, 22)]
    out, state = watched(rocks, tmp_path, batches, width=5)
    touched = {s["numRowsUpdated"] for s in state}
    assert [s["numRowsTotal"] for s in state] == [30] * len(state) and 1 in touched
    assert sorted(touched)[:-1] in ([1], [0, 1])
    rows = {r.run_id: r.last_step for r in latest(rocks, out, ["run_id"]).collect()}
    assert rows == {f"r{r}": 21 if r == 7 else 1 for r in range(30)}


def test_silent_runs_leave_the_state(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    batches = [[("a", 1, 1.0, None, at(0))], [("b", 1, 1.0, None, at(20))], [("b", 2, 1.0, None, at(21))], [("b", 3, 1.0, None, at(22))]]
    out, state = watched(spark, tmp_path, batches, f"{jobs.STEP_ROWS}, at timestamp", time="at", silence=10_000)
    assert state[-1]["numRowsTotal"] == 1
    assert {r.run_id: r.last_step for r in latest(spark, out, ["run_id"]).collect()} == {"a": 1, "b": 3}


LOG = (
    "run_id string, step bigint, loss double, lr double, step_time_ms double, grad_norm double, batch_size int, seq_len int, at timestamp"
)


def test_closed_runs_are_given_out_once(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    row = lambda run, step, second: (run, step, 1.0 / step, 0.1, 5.0, None, 2, 4, second and at(second))
    batches = [
        [row("a", 1, 1), row("a", 2, 2), row("b", 1, 2), row("b", 9, None)],
        [row("a", 3, 8), row("b", 2, 100)],
        [row("b", 3, 101)],
        [row("a", 4, 9), row("c", 1, 300)],  # the row of run a is later than the watermark
        [row("c", 2, 301)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    closed = jobs.closed_runs(stream.withWatermark("at", "1 second"), "at", "30 seconds")
    drain(closed, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch_id={n}"))
    got = sorted((r.run_id, r.steps, r.best_step, r.best_loss) for r in spark.read.parquet(out).collect())
    assert got == [("a", 3, 3, 1 / 3), ("b", 1, 1, 1.0), ("b", 3, 3, 1 / 3)]


@pytest.mark.parametrize("seed", range(20))
def test_outcomes_follow_the_rule(seed):
    rng = np.random.default_rng(seed)
    n, patience = 60, int(rng.integers(1, 7))
    group = np.sort(rng.integers(0, 4, n))
    val = rng.choice([0.1, 0.5, 0.5005, 0.9, np.nan, np.inf, -np.inf], n)
    extra = rng.integers(0, 2, n)
    goes, waited, stops = outcomes(group, val, extra, patience, 0.001)
    for i in np.flatnonzero(~np.isnan(val) & (val < np.inf)):
        best, count, stop, j = i, int(extra[i]), -1, i
        while count < patience and j + 1 < n and group[j + 1] == group[i]:
            j += 1
            if val[j] < np.inf and val[best] - val[j] > 0.001:
                best, count = j, int(extra[j])
            else:
                count += 1 + int(extra[j])
        stop = j if count >= patience else -1
        assert (goes[i], waited[i], stops[i]) == (best, count, stop)


def test_early_stop_in_one_job_over_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        rows = [(run, i, 10 * i, None if i % 5 == 0 else float(200 - i if run else i), None) for run in ("a", None, "") for i in range(1, 101)]
        evals = spark.createDataFrame(rows, "run_id string, eval_no bigint, step bigint, val_loss double, train_loss double")
        got = {r.run_id: (r.best, r.waited, r.stop_step) for r in metrics.early_stop(evals, block_evals=30).collect()}
    finally:
        spark.conf.set(name, before)
    assert got == {"a": (101.0, 1, None), None: (1.0, 5, 60), "": (1.0, 5, 60)}
    assert metrics.early_stop(evals.limit(0)).collect() == []
