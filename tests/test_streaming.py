"""Streams over several batches give what the batch jobs give."""

import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import metrics
from gristmill.streaming import jobs
from gristmill.streaming.sinks import drain, latest


def test_cap_over_batches_counts_blank_rows(spark, tmp_path):
    schema = "doc_id bigint, text string"
    put = jobs.capped(str(tmp_path / "out"), "doc_id", 5)
    first = [(1, "a"), (2, " "), (3, "c")]
    second = [(4, ""), (5, "e"), (6, "f")]
    third = [(7, "g")]
    for n, rows in enumerate((first, second, third)):
        put(spark.createDataFrame(rows, schema), n)
    put(spark.createDataFrame(second, schema), 1)  # the same batch again
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out/rows")).collect()) == [1, 3, 5]


def steps(seed, runs=4, n=160):
    rng = random.Random(seed)
    rows = []
    for r in range(runs):
        for s in range(1, n + 1):
            loss = rng.choice([0.001, 0.9]) if s < 60 else rng.choice([0.001, 0.002])
            rows.append((f"r{r}", s, loss, rng.uniform(0, 2) if s % 10 == 0 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_monitor_equals_batch(spark, tmp_path, seed):
    rows = steps(seed)
    rules = dict(patience=4, overfit_train=0.3, overfit_ratio=2.0)
    put = jobs.monitor(str(tmp_path / "s"), width=20, eval_interval=10, streak=15, below=0.1, after_step=30, **rules)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    cuts = [shuffled[i::3] for i in range(3)]
    for n, part in enumerate(cuts):
        put(spark.createDataFrame(part, jobs.STEP_ROWS), n)
    put(spark.createDataFrame(cuts[2], jobs.STEP_ROWS), 2)  # the same batch again
    got = {r.run_id: (r.last_step, r.stop_step, r.best, r.detect_step) for r in jobs.monitor_state(spark, str(tmp_path / "s")).collect()}

    log = spark.createDataFrame(rows, jobs.STEP_ROWS)
    means = metrics.smoothed_loss(log, 20)
    evals = means.filter("val_loss is not null").select(
        "run_id", (F.col("step") / 10).cast("bigint").alias("eval_no"), "step", "val_loss", F.col("avg_loss").alias("train_loss")
    )
    stops = {r.run_id: (r.stop_step, r.best) for r in metrics.early_stop(evals, **rules).collect()}
    found = {r.run_id: r.detect_step for r in metrics.overfit_stop(metrics.overfit_streaks(means, 0.1, 30), 15).collect()}
    assert got == {r: (160, *stops[r], found.get(r)) for r in stops}


def test_monitor_waits_for_missing_steps(spark, tmp_path):
    put = jobs.monitor(str(tmp_path / "s"), width=5, eval_interval=10)
    put(spark.createDataFrame([("r", 1, 1.0, None), ("r", 3, 1.0, None)], jobs.STEP_ROWS), 0)
    assert jobs.monitor_state(spark, str(tmp_path / "s")).first().last_step == 1
    put(spark.createDataFrame([("r", 2, 1.0, None)], jobs.STEP_ROWS), 1)
    assert jobs.monitor_state(spark, str(tmp_path / "s")).first().last_step == 3


def test_events_assemble_when_the_end_arrives(spark, tmp_path):
    put = jobs.event_assembly(str(tmp_path / "e"))
    one = [(1, 0, "start", None), (1, 1, "token", "He"), (2, 1, "token", "x")]
    two = [(1, 2, "token", "llo"), (1, 3, "complete", None), (1, 4, "token", "late"), (2, 2, "error", None), (3, 1, "complete", None)]
    for n, rows in enumerate((one, two)):
        put(spark.createDataFrame(rows, jobs.EVENT_ROWS), n)
    done = spark.read.parquet(str(tmp_path / "e/done")).collect()
    assert {r.request_id: (r.text, r.tokens, r.finish) for r in done} == {1: ("Hello", 2, "complete"), 2: ("x", 1, "error"), 3: ("", 0, "complete")}


def test_ledger_append_once(spark, tmp_path):
    schema = "run_id bigint, ts timestamp_ntz, cost double"
    put = jobs.ledger_append(str(tmp_path / "l"), "run_id", "ts", schema)
    import datetime as dt

    a, b, c = (1, dt.datetime(2024, 1, 5), 1.0), (2, dt.datetime(2024, 2, 5), 2.0), (3, dt.datetime(2024, 2, 6), 3.0)
    put(spark.createDataFrame([a, a, b], schema), 0)
    put(spark.createDataFrame([b, c], schema), 1)
    put(spark.createDataFrame([b, c], schema), 1)
    assert sorted(r.run_id for r in spark.read.parquet(str(tmp_path / "l")).collect()) == [1, 2, 3]


def test_a_ledger_batch_leaves_few_files(spark, tmp_path):
    """Each task left a file in each month, which every later batch had to open."""
    schema = "run_id bigint, ts timestamp_ntz, cost double"
    put = jobs.ledger_append(str(tmp_path / "l"), "run_id", "ts", schema)
    rows = spark.range(0, 5000, 1, 8).select(
        F.col("id").alias("run_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, cast(id % 12 as int))").alias("ts"),
        F.when(F.col("id") % 7 > 0, F.col("id") / 2).alias("cost"),
    )
    put(rows.limit(3000), 0)
    put(rows, 1)
    got = spark.read.parquet(str(tmp_path / "l"))
    assert sorted(r.run_id for r in got.collect()) == list(range(5000))
    assert len(list((tmp_path / "l" / "batch_id=1").rglob("part-*.parquet"))) <= 12


def test_online_metrics_equal_batch(spark, tmp_path):
    rows = [(f"r{i % 3}", i // 3 + 1, float((i * 7) % 11), 0.1, 5.0, None, 2, 4) for i in range(60)]
    schema = "run_id string, step bigint, loss double, lr double, step_time_ms double, grad_norm double, batch_size int, seq_len int"
    for n in range(3):
        spark.createDataFrame(rows[n * 20:(n + 1) * 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    drain(jobs.online_metrics(stream), lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), "update", str(tmp_path / "cp"))
    got = latest(spark, out, ["run_id"])
    want = metrics.run_summary(spark.createDataFrame(rows, schema))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_the_registered_monitor_spreads_long_runs(spark, monkeypatch):
    """Each of its runs holds a fifth of the stream: as state of one key, the waiting steps never got done on 6 million rows."""
    from check_oracle import compare, database

    spreading, used = jobs.monitor, []
    monkeypatch.setattr(jobs, "monitor", lambda *args, **rules: used.append(rules) or spreading(*args, **rules))
    assert compare(spark, database("/root/testdata/sf0.001"), "T04_run_monitor", "/root/testdata/sf0.001") == ""
    assert used and used[0]["eval_interval"] == 10
