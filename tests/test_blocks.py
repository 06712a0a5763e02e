"""Block-wise operators against plain Python, with blocks small enough to matter."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gristmill.operators import corpus, ledger, metrics
from gristmill.operators.blocks import nth_keys, number_in_order, positions, running, sliding_mean, trailing


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for key, n in (("hot", 400), ("a", 37), ("b", 1), ("c", 120)):
        out += [(key, i + 1, rng.randint(0, 50)) for i in range(n)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module", params=[1, 7])
def table(spark, rows, request):
    return spark.createDataFrame(rows, "run_id string, step bigint, v bigint").repartition(request.param)


def by_key(rows):
    out = {}
    for k, s, v in sorted(rows):
        out.setdefault(k, []).append((s, v))
    return out


def test_positions(table, rows):
    got = positions(table, ["run_id"], ["v", "step"], F.floor(F.col("v") / 7), "p", total="n").collect()
    want = {}
    for k, items in by_key(rows).items():
        for i, (v, s) in enumerate(sorted((v, s) for s, v in items)):
            want[k, s] = (i + 1, len(items))
    assert {(r.run_id, r.step): (r.p, r.n) for r in got} == want


def test_number_in_order(table, rows):
    got = number_in_order(table, ["v", "run_id", "step"]).collect()
    want = {(k, s): i for i, (v, k, s) in enumerate(sorted((v, k, s) for k, s, v in rows))}
    assert {(r.run_id, r.step): r.pos for r in got} == want


def test_running(table, rows):
    got = running(table, ["run_id"], ["step"], F.floor(F.col("step") / 16), {
        "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "before": ("max_before", F.col("v")), "sum_ahead": ("sum_before", F.col("v")),
    }).collect()
    want = {}
    for k, items in by_key(rows).items():
        total, low, high = 0, None, None
        for s, v in items:
            ahead = total
            total, low = total + v, v if low is None else min(low, v)
            want[k, s] = (total, low, high, ahead)
            high = v if high is None else max(high, v)
    assert {(r.run_id, r.step): (r.total, r.low, r.before, r.sum_ahead) for r in got} == want


@pytest.mark.parametrize("width,block", [(5, 5), (5, 8), (100, 100), (3, 1000)])
def test_trailing(table, rows, width, block):
    got = trailing(table, ["run_id"], "step", width, {"t": F.sum("v")}, block).collect()
    want = {(k, s): sum(v for _, v in items[max(0, s - width):s]) for k, items in by_key(rows).items() for s, _ in items}
    assert {(r.run_id, r.step): r.t for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("block", [112, 1600, 100_000])
def test_sliding_mean_adds_in_the_order_of_sql(spark, block):
    """Means that are exactly a bound must fall on the side of it where SQL's fall."""
    rng = random.Random(11)
    losses = [None if rng.random() < 0.02 else rng.randint(1, 9999) / 10_000 for _ in range(3000)]
    table = spark.createDataFrame(list(enumerate(losses, 1)), "step bigint, loss double").withColumn("run_id", F.lit("a"))
    got = {r.step: r.m for r in sliding_mean(table, ["run_id"], "step", 100, "loss", "m", block).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(range(1, 3001)) AS step, unnest(?::DOUBLE[]) AS loss", [losses])
    want = dict(con.execute("SELECT step, avg(loss) OVER (ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) FROM t").fetchall())
    assert got == want


def test_sliding_mean_of_nothing_known(spark):
    table = spark.createDataFrame([("a", 1, None), ("a", 2, 4.0), ("a", 3, None)], "run_id string, step bigint, v double")
    got = sliding_mean(table, ["run_id"], "step", 2, "v", "m").orderBy("step").collect()
    assert [r.m for r in got] == [None, 4.0, 4.0]


def test_nth_keys_with_repeats(spark, monkeypatch):
    values = sorted([5] * 300 + list(range(-50, 900, 3)) + [2**40] * 10)
    df = spark.createDataFrame([(v,) for v in values], "k bigint")
    cuts = nth_keys(df, "k", [1, 200, 350, len(values), len(values) + 1])
    assert cuts.rows == len(values) and cuts.keys == {r: values[r - 1] for r in (1, 200, 350, len(values))}
    assert cuts.inside_ties == {r for r in (1, 200, 350) if values[r - 1] == values[r]}
    assert nth_keys(df.filter("k = 5"), "k", lambda n: [n - 1, n]).inside_ties == {299}


def test_nth_keys_narrows_large_ranges(spark):
    df = spark.range(300_000).select((F.col("id") * 1_000_003).alias("k"))
    assert nth_keys(df, "k", [1, 123_456, 300_000]).keys == {1: 0, 123_456: 123_455 * 1_000_003, 300_000: 299_999 * 1_000_003}


def simulate_early_stop(evals, patience=5, delta=0.001, low=0.01, ratio=10.0):
    best, waited = float("inf"), 0
    for step, val, train in evals:
        if best - val > delta:
            best, waited = val, 0
        else:
            waited += 1
        if train < low and val > train * ratio:
            waited += 1
        if waited >= patience:
            return best, waited, step
    return (None if best == float("inf") else best), waited, None


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_early_stop_in_blocks(spark, block):
    rng = random.Random(block)
    runs = {f"r{i}": [(10 * (n + 1), rng.choice([1.0, 0.5, 0.9, 0.1, float("nan")]) - n * 0.05, rng.choice([0.005, 1.0])) for n in range(rng.randint(1, 14))] for i in range(12)}
    rows = [(k, i + 1, *e) for k, evals in runs.items() for i, e in enumerate(evals)]
    df = spark.createDataFrame(rows, "run_id string, eval_no bigint, step bigint, val_loss double, train_loss double")
    got = {r.run_id: (r.best, r.waited, r.stop_step) for r in metrics.early_stop(df, block_evals=block).collect()}
    assert got == {k: simulate_early_stop(v) for k, v in runs.items()}


def test_blended_step_time_is_the_fold(spark):
    rng = random.Random(1)
    times = [rng.uniform(1, 9) for _ in range(437)]
    avg, kept = 0.0, 0
    for i, t in enumerate(times, 1):
        avg = (avg * kept + t) / (kept + 1)
        kept += i % 100 == 0 or i == 1
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(times, 1)], "run_id string, step bigint, step_time_ms double")
    assert metrics.blended_step_time(df).first().step_time_ms == pytest.approx(avg)


def simulate_gate(items, left):
    out = {}
    for pos, cost in items:
        out[pos] = cost <= left
        left -= cost if cost <= left else 0
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_affordable(spark, seed):
    rng = random.Random(seed)
    due, left, want = [], [], {}
    for k in range(12):
        items = [(p, rng.choice([0, 1, 2, 5, 30, 200, rng.randint(0, 400)])) for p in range(rng.randint(1, 60))]
        money = rng.choice([0, 1, 50, 300, 1000, 10**6])
        due += [(k, p, c) for p, c in items]
        left.append((k, money))
        want.update({(k, p): ok for p, ok in simulate_gate(items, money).items()})
    d = spark.createDataFrame(due, "ledger int, pos bigint, cost bigint")
    b = spark.createDataFrame(left, "ledger int, remaining bigint")
    got = ledger.affordable(d, b).collect()
    assert {(r.ledger, r.pos): r.accepted for r in got} == want


def test_runs_without_a_budget_stay(spark):
    due = spark.createDataFrame([(1, 1, 5), (2, 1, 5), (None, 1, 5), (1, 2, None)], "ledger int, pos bigint, cost bigint")
    budgets = spark.createDataFrame([(1, 10), (3, 10), (None, 10)], "ledger int, remaining bigint")
    got = {(r.ledger, r.pos): r.accepted for r in ledger.affordable(due, budgets).collect()}
    assert got == {(1, 1): True, (1, 2): False, (2, 1): False, (None, 1): False}
    assert [r.accepted for r in ledger.affordable(due, budgets.limit(0)).collect()] == [False] * 4


def test_null_keys_and_orders_stay(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("a", 1), ("a", 2)], "k string, v int")
    got = positions(df, ["k"], ["v"], F.floor(F.col("v") / 2)).collect()
    assert sorted(((r.k or "", r.v or 0, r.pos) for r in got)) == [("", 1, 1), ("a", 0, 1), ("a", 1, 2), ("a", 2, 3)]
    total = running(df, ["k"], ["v"], F.floor(F.col("v") / 2), {"n": ("sum", F.lit(1))}).collect()
    assert sorted((r.k or "", r.n) for r in total) == [("", 1), ("a", 1), ("a", 2), ("a", 3)]


def test_nth_keys_of_any_key(spark):
    n = 300_000
    hashes = spark.range(n).select(F.xxhash64("id").alias("k"))
    want = sorted(r.k for r in hashes.collect())
    assert nth_keys(hashes, "k", [1, 777, n]).keys == {1: want[0], 777: want[776], n: want[-1]}
    names = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "k string")
    cuts = nth_keys(names, "k", lambda rows: [1, 2, rows])
    assert cuts.rows == 4 and cuts.keys == {1: "a", 2: "b", 4: "c"} and cuts.inside_ties == {2}
    docs = spark.createDataFrame([(k, k) for k in "dbac"], "doc_id string, text string")
    assert sorted(r.doc_id for r in corpus.cap_rows(docs, "doc_id", 2).collect()) == ["a", "b"]


def test_apply_events(spark):
    rng = random.Random(9)
    runs, events, want = [], [], {}
    for k in range(15):
        n = rng.randint(1, 8)
        state = [["pending", None, None] for _ in range(n)]
        runs += [(k, 100 * k + i) for i in range(n)]
        for e in range(rng.randint(0, 30)):
            kind = rng.choice(["start", "start", "complete", "fail"])
            events.append((k, 1000 * k + e, kind))
            wanted = "pending" if kind == "start" else "running"
            hit = next((s for s in state if s[0] == wanted), None)
            if hit is not None:
                hit[0] = {"start": "running", "complete": "completed", "fail": "failed"}[kind]
                hit[1 if kind == "start" else 2] = 1000 * k + e
        want.update({(k, 100 * k + i): tuple(s) for i, s in enumerate(state)})
    ledger_df = spark.createDataFrame(runs, "dataset int, run_no bigint")
    events_df = spark.createDataFrame(events, "dataset int, event_no bigint, kind string")
    got = ledger.apply_events(ledger_df, events_df, F.floor(F.col("run_no") / 3), F.floor(F.col("event_no") / 4)).collect()
    assert {(r.dataset, r.run_no): (r.status, r.started_by, r.ended_by) for r in got} == want
    for whole in (0, 20):  # all datasets in blocks, and the larger ones only
        got = ledger.apply_events(ledger_df, events_df, F.floor(F.col("run_no") / 3), F.floor(F.col("event_no") / 4), whole=whole).collect()
        assert {(r.dataset, r.run_no): (r.status, r.started_by, r.ended_by) for r in got} == want


def test_apply_events_takes_more_tasks_for_more_rows(spark):
    runs = spark.range(4000).select((F.col("id") % 400).cast("int").alias("dataset"), F.col("id").alias("run_no"))
    starts = runs.select("dataset", F.col("run_no").alias("event_no"), F.lit("start").alias("kind"))
    got = ledger.apply_events(runs, starts, F.lit(0), F.floor(F.col("event_no") / 100), task_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Each carry was a join; 8000 rows were as many tasks as a shuffle has.
    assert "Join" not in plan and "hashpartitioning(dataset" in plan and ", 80), REPARTITION_BY_NUM" in plan
    assert got.filter("started_by = run_no AND status = 'running'").count() == 4000


def test_apply_events_leaves_runs_without_a_dataset_pending(spark):
    runs = spark.createDataFrame([(None, 1), ("a", 2)], "dataset string, run_no bigint")
    events = spark.createDataFrame([(None, 1, "start"), ("a", 2, "start"), ("a", 3, None), ("b", 4, "start")], "dataset string, event_no bigint, kind string")
    got = ledger.apply_events(runs, events, F.lit(0), F.lit(0)).collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 2, "running", 2, None), (None, 1, "pending", None, None)]


def test_session_without_runs_is_pending(spark):
    runs = spark.createDataFrame([("s", "failed", 1, 1, 1.0, 1.0)], "session_id string, status string, steps bigint, tokens bigint, cost double, hours double")
    sessions = spark.createDataFrame([("s",), ("empty",)], "session_id string")
    out = {r.session_id: (r.status, r.runs) for r in ledger.session_rollup(runs, sessions).collect()}
    assert out == {"s": ("failed", 1), "empty": ("pending", 0)}


def test_validation_without_batches_has_no_row_and_ignored_targets_give_null(spark):
    scores = spark.createDataFrame([(1, -1, 2.0), (2, 5, 3.0), (2, -1, 9.0)], "k int, target int, score double")
    assert {r.k: r.loss for r in metrics.masked_mean(scores, ["k"]).collect()} == {1: None, 2: 3.0}
