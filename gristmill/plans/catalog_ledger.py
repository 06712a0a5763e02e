"""Queries over ledgers of runs, spend, schedules, lineage, checkpoints and checks.

`orders` stands in for spend, schedules and runs (tenant = customer), `lineitem` for events,
checkpoints and phase results, `part` for run configurations.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import scalars as S
from gristmill.functions import text as X
from gristmill.operators import encode
from gristmill.operators import ledger as L
from gristmill.operators.blocks import number_in_order, positions
from gristmill.operators.gather import concat_in_order
from gristmill.plans.catalog_corpus import RECORDS_SQL, learnt
from gristmill.plans.catalog_metrics import rounded
from gristmill.plans.registry import query, table
from gristmill.session import scratch, tasks_for
from gristmill.sources import readers, writers
from gristmill.streaming import jobs
from gristmill.streaming.keyed import FINISHED, assembled_requests
from gristmill.streaming.sinks import drain, files_per_batch, put_batch

AS_OF = "2001-07-20 12:00:00"
BUDGET = 500_000.0


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def spend(spark, d) -> DataFrame:
    return orders(spark, d).select(
        F.col("o_custkey").alias("tenant"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("cost"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).alias("phase"),
    )


MONTH_SQL = f"o_orderdate >= date_trunc('month', TIMESTAMP '{AS_OF}')"
SPEND_SQL = f"""SELECT o_custkey AS tenant, round(coalesce(sum(o_totalprice) FILTER (WHERE {MONTH_SQL}), 0), 2) AS current_month,
    round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAYS), 0), 2) AS last_30_days,
    round(sum(o_totalprice), 2) AS all_time, count(*) AS total_runs,
    round({BUDGET} - coalesce(sum(o_totalprice) FILTER (WHERE {MONTH_SQL}), 0), 2) AS remaining,
    round({BUDGET} * 0.9 - coalesce(sum(o_totalprice) FILTER (WHERE {MONTH_SQL}), 0), 2) AS remaining_safe,
    round(coalesce(sum(o_totalprice) FILTER (WHERE {MONTH_SQL}), 0) / {BUDGET}::DOUBLE * 100, 4) AS utilization_pct FROM orders GROUP BY o_custkey"""


@query("A10_spend_summary", SPEND_SQL)
def a10(spark, d):
    out = L.spend_summary(spend(spark, d), AS_OF, BUDGET)
    out = rounded(out, "current_month", "last_30_days", "all_time", "remaining", "remaining_safe", digits=2)
    return rounded(out, "utilization_pct", digits=4)


PHASE_SQL = """phases AS (SELECT o_custkey AS tenant, CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS phase,
    o_totalprice AS cost FROM orders)"""


@query("A11_spend_by_phase", f"WITH {PHASE_SQL} SELECT tenant, phase, round(sum(cost), 2) AS cost FROM phases WHERE phase <> '' GROUP BY tenant, phase")
def a11(spark, d):
    return rounded(L.spend_by_phase(spend(spark, d)), "cost", digits=2)


@query("A11_spend_map", f"""WITH {PHASE_SQL}, s AS (SELECT tenant, phase, sum(cost) AS cost FROM phases WHERE phase <> '' GROUP BY tenant, phase)
    SELECT tenant, count(*) AS entries, string_agg(phase, ',' ORDER BY phase) AS names,
        string_agg(round(cost * 100)::BIGINT, ',' ORDER BY phase) AS cents FROM s GROUP BY tenant""")
def a11_map(spark, d):
    spent = L.spend_map(L.spend_by_phase(spend(spark, d)))
    cents = F.transform(F.map_values("by_phase"), lambda c: F.round(c * 100).cast("bigint").cast("string"))
    return spent.select(
        "tenant", F.size("by_phase").cast("bigint").alias("entries"), F.array_join(F.map_keys("by_phase"), ",").alias("names"), F.array_join(cents, ",").alias("cents")
    )


@query("P05_period_filters", f"""SELECT o_orderkey, {MONTH_SQL} AS this_month, o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAYS AS last_30_days FROM orders""")
def p05(spark, d):
    now = F.lit(AS_OF).cast("timestamp_ntz")
    return orders(spark, d).select(
        "o_orderkey", L.in_current_month(F.col("o_orderdate"), now).alias("this_month"),
        L.in_last_30_days(F.col("o_orderdate"), now).alias("last_30_days"),
    )


# ---------------------------------------------------------------- schedule


def schedule(spark, d) -> DataFrame:
    status = F.create_map(*[F.lit(x) for x in ("P", "pending", "O", "running", "F", "completed")])
    failed = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    skipped = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    return orders(spark, d).select(
        F.col("o_custkey").alias("tenant"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("scheduled"),
        F.when(failed, "failed").when(skipped, "skipped").otherwise(status[F.col("o_orderstatus")]).alias("status"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("completed_at"),
        "o_totalprice",
    )


SCHEDULE_SQL = """schedule AS (SELECT o_custkey AS tenant, o_orderkey AS run_id, o_orderdate AS scheduled, o_totalprice,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'failed' WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'skipped'
        WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'O' THEN 'running' ELSE 'completed' END AS status,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d') END AS completed_at FROM orders)"""


@query("P04_due_runs", f"WITH {SCHEDULE_SQL} SELECT tenant, run_id FROM schedule WHERE status = 'pending' AND scheduled <= TIMESTAMP '1998-06-01'")
def p04(spark, d):
    return L.due_runs(schedule(spark, d), "1998-06-01 00:00:00").select("tenant", "run_id")


@query("A12_schedule_counts", f"""WITH {SCHEDULE_SQL} SELECT tenant, count(*) FILTER (WHERE status = 'pending') AS pending,
    count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'completed') AS completed,
    count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS total FROM schedule GROUP BY tenant""")
def a12(spark, d):
    return L.schedule_counts(schedule(spark, d))


@query("O02_recent_history", f"""WITH {SCHEDULE_SQL} SELECT run_id, status FROM schedule WHERE status IN ('completed', 'failed')
    ORDER BY coalesce(completed_at, '') DESC, run_id LIMIT 10""")
def o02(spark, d):
    return L.recent_history(schedule(spark, d)).select("run_id", "status")


EVENTS_A_TASK = 1_000_000


def timed_events(spark, d) -> DataFrame:
    """Start and end events per customer."""
    kind = F.when(F.col("l_linestatus") == "O", "start").when(F.col("l_returnflag") == "R", "fail").otherwise("complete")
    owner = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("dataset"))
    items = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_linestatus", "l_returnflag"
    )
    usual, tasks = (tasks_for(spark, n, EVENTS_A_TASK) for n in (0, items.count()))
    if tasks > usual:  # a join sorts what a task holds
        items, owner = items.repartition(tasks, "l_orderkey"), owner.repartition(tasks, "o_orderkey")
    return items.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "dataset", F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_extendedprice", kind.alias("kind"),
    )


def run_events(spark, d) -> DataFrame:
    """The events, numbered in time order."""
    order = ["ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, d, "lineitem").count()
    return number_in_order(timed_events(spark, d), order, "event_no", rows, EVENTS_A_TASK).select("dataset", "event_no", "kind")


EVENTS_SQL = """events_of AS (SELECT o_custkey AS dataset, l_orderkey, l_shipdate AS ts,
    row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS event_no,
    CASE WHEN l_linestatus = 'O' THEN 'start' WHEN l_returnflag = 'R' THEN 'fail' ELSE 'complete' END AS kind
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("L01_apply_events", f"""WITH RECURSIVE {EVENTS_SQL}, runs AS (SELECT o_custkey AS dataset, o_orderkey AS run_no,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
    e AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY event_no) AS i FROM events_of),
    f(dataset, i, n, started, ended, hit, event_no, kind) AS (SELECT DISTINCT dataset, 0::BIGINT, n, 0::BIGINT, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::VARCHAR FROM runs
        UNION ALL SELECT f.dataset, e.i, f.n, started + CASE WHEN e.kind = 'start' AND started < n THEN 1 ELSE 0 END,
            ended + CASE WHEN e.kind <> 'start' AND ended < started THEN 1 ELSE 0 END,
            CASE WHEN e.kind = 'start' AND started < n THEN started + 1 WHEN e.kind <> 'start' AND ended < started THEN ended + 1 END, e.event_no, e.kind
        FROM f JOIN e ON e.dataset = f.dataset AND e.i = f.i + 1)
    SELECT r.dataset, r.run_no, coalesce(CASE max(f.kind) FILTER (WHERE f.kind <> 'start') WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'failed' END,
        CASE WHEN count(f.kind) > 0 THEN 'running' ELSE 'pending' END) AS status,
        max(f.event_no) FILTER (WHERE f.kind = 'start') AS started_by, max(f.event_no) FILTER (WHERE f.kind <> 'start') AS ended_by
    FROM runs r LEFT JOIN f ON f.dataset = r.dataset AND f.hit = r.k GROUP BY r.dataset, r.run_no""")
def l01(spark, d):
    runs = orders(spark, d).select(F.col("o_custkey").alias("dataset"), F.col("o_orderkey").alias("run_no"))
    return L.apply_events(
        runs, run_events(spark, d),
        F.floor(F.col("run_no") / 100_000), F.floor(F.col("event_no") / 100_000),
    )


@query("L02_run_outcome", f"""WITH {EVENTS_SQL}, o AS (SELECT l_orderkey AS run_id, min(ts) FILTER (WHERE kind = 'start') AS s,
    max({{'t': ts, 'k': kind}}) FILTER (WHERE kind <> 'start') AS e FROM events_of GROUP BY l_orderkey)
    SELECT run_id, strftime(s, '%Y-%m-%d') AS started_at, strftime(e.t, '%Y-%m-%d') AS completed_at,
    coalesce(CASE e.k WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'failed' END, CASE WHEN s IS NOT NULL THEN 'running' ELSE 'pending' END) AS status, round(datediff('hour', s, e.t)::DOUBLE, 6) AS hours FROM o""")
def l02(spark, d):
    out = L.run_outcome(timed_events(spark, d).withColumnRenamed("l_orderkey", "run_id"))
    return rounded(out, "hours").withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("started_at", "completed_at")})


@query("F20_duration", """SELECT l_orderkey, round(sum(datediff('day', o_orderdate, l_shipdate) * 24.0::DOUBLE), 6) AS hours
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""")
def f20(spark, d):
    both = table(spark, d, "lineitem").join(orders(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    hours = S.duration_hours(F.col("o_orderdate"), F.col("l_shipdate").cast("timestamp_ntz"))
    return rounded(both.groupBy("l_orderkey").agg(F.sum(hours).alias("hours")), "hours")


GATE_SQL = """due AS (SELECT o_custkey AS ledger, o_orderkey AS pos, round(o_totalprice * 100)::BIGINT AS cost,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
    f(ledger, i, remaining, pos, accepted) AS (SELECT DISTINCT ledger, 0::BIGINT, 100000000::BIGINT, NULL::BIGINT, NULL::BOOLEAN FROM due
        UNION ALL SELECT f.ledger, d.i, CASE WHEN d.cost <= f.remaining THEN f.remaining - d.cost ELSE f.remaining END, d.pos, d.cost <= f.remaining
        FROM f JOIN due d ON d.ledger = f.ledger AND d.i = f.i + 1)"""


def due_costs(spark, d) -> tuple[DataFrame, DataFrame]:
    due = orders(spark, d).select(
        F.col("o_custkey").alias("ledger"), F.col("o_orderkey").alias("pos"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cost")
    )
    return due, due.select("ledger").distinct().withColumn("remaining", F.lit(100_000_000).cast("bigint"))


@query("W15_affordability_gate", f"WITH RECURSIVE {GATE_SQL} SELECT ledger, pos, accepted FROM f WHERE i > 0")
def w15(spark, d):
    return L.affordable(*due_costs(spark, d)).select("ledger", "pos", "accepted")


@query("W15_affordability_rounds", f"WITH RECURSIVE {GATE_SQL} SELECT ledger, pos, accepted FROM f WHERE i > 0")
def w15_rounds(spark, d):
    return L.affordable(*due_costs(spark, d)).select("ledger", "pos", "accepted")


# ---------------------------------------------------------------- costs

PROFILE_SQL = """profiles AS (SELECT p_partkey AS profile, 10000 + p_size * 800 AS v, 128 * (1 + p_size // 8) AS d, 4 + p_size // 2 AS n,
        512 * (1 + p_size // 8) AS f, 256 AS seq, 1000 * p_size AS steps, p_retailprice / 100 AS spent, p_size FROM part),
    gpus AS (SELECT * FROM (VALUES ('T4', 1, 0.5::DOUBLE, 100, 16), ('A10G', 2, 1.1::DOUBLE, 250, 24), ('A100-40GB', 3, 3.0::DOUBLE, 500, 40),
        ('A100-80GB', 4, 4.0::DOUBLE, 600, 80), ('H100', 5, 5.0::DOUBLE, 800, 80)) g(gpu, gpu_order, price, spm, mem)),
    sized AS (SELECT *, greatest(1.0::DOUBLE, round((v::BIGINT * d + 4::BIGINT * n * d * d + 3::BIGINT * n * d * f) / 1e6::DOUBLE, 1)) AS params_m,
        (2::BIGINT * v * d + 4::BIGINT * n * d * d + 2::BIGINT * n * d * f)::DOUBLE * 4 / 1073741824 AS model_gb, n::DOUBLE * seq * d * 16 / 1073741824 AS sample_gb FROM profiles),
    timed AS (SELECT *, steps / (spm * greatest(0.5::DOUBLE, least(2.0::DOUBLE, 200.0::DOUBLE / params_m)) * 60) * 1.1::DOUBLE AS hours FROM sized, gpus),
    sweep AS (SELECT *, hours * price AS cost, mem * 0.8::DOUBLE - model_gb * 3 AS free_gb FROM timed)"""


def profiles(spark, d) -> DataFrame:
    size = F.col("p_size")
    step = F.expr("p_size div 8").cast("int")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("profile"), (10000 + size * 800).alias("vocab_size"), (128 * (1 + step)).alias("d_model"),
        (4 + F.expr("p_size div 2").cast("int")).alias("num_layers"), (512 * (1 + step)).alias("d_ff"), F.lit(256).alias("seq_len"),
        (1000 * size).alias("max_steps"), (F.col("p_retailprice") / 100).alias("spent"), "p_brand",
    )


@query("J04_cost_sweep", f"""WITH {PROFILE_SQL} SELECT profile, gpu, params_m, round(hours, 6) AS hours, round(cost, 6) AS cost,
    CASE WHEN free_gb > 0 THEN power(2, floor(log2(greatest(1, least(256, floor(free_gb / sample_gb))))))::BIGINT END AS batch,
    cost <= 30 - spent AS within_budget, cost <= 30.0::DOUBLE * 0.9::DOUBLE - spent AS within_safety, round((spent + cost) / 30 * 100, 6) AS utilization_pct FROM sweep""")
def j04(spark, d):
    out = L.cost_sweep(profiles(spark, d), 30.0).select(
        "profile", "gpu", "params_m", "hours", "cost", F.col("batch").cast("bigint").alias("batch"), "within_budget", "within_safety", "utilization_pct"
    )
    return rounded(out, "hours", "cost", "utilization_pct")


@query("F15_parameter_counts", """SELECT p_partkey AS profile, greatest(1.0::DOUBLE, round((v * d + 4 * n * d * d + 3 * n * d * f) / 1e6::DOUBLE, 1)) AS millions,
    v * d + 12 * n * d * d AS attention_only, 2 * v * d + 4 * n * d * d + 2 * n * d * f AS tied_twice FROM (
    SELECT p_partkey, (10000 + p_size * 800)::BIGINT AS v, (128 * (1 + p_size // 8))::BIGINT AS d, (4 + p_size // 2)::BIGINT AS n, (512 * (1 + p_size // 8))::BIGINT AS f FROM part)""")
def f15(spark, d):
    v, w, n, f = (F.col(c) for c in ("vocab_size", "d_model", "num_layers", "d_ff"))
    return profiles(spark, d).select(
        "profile", S.params_millions(v, w, n, f).alias("millions"), S.params_attention_only(v, w, n).alias("attention_only"),
        S.params_tied_twice(v, w, n, f).alias("tied_twice"),
    )


@query("F16_memory", f"""WITH {PROFILE_SQL} SELECT profile, round((((v::BIGINT * d + 12::BIGINT * n * d * d)::DOUBLE * 4 / 1073741824) * 3
    + 32.0::DOUBLE * seq * d * n * 4 / 1073741824) * 1.2::DOUBLE, 6) AS memory_gb,
    round((v::BIGINT * d + 12::BIGINT * n * d * d)::DOUBLE * 4 / 1048576 * 4, 4) AS training_mb FROM sized""")
def f16(spark, d):
    gb = S.memory_gb(F.col("vocab_size"), F.col("d_model"), F.col("num_layers"), F.lit(32), F.col("seq_len"))
    mb = S.training_mb(S.params_attention_only(F.col("vocab_size"), F.col("d_model"), F.col("num_layers")))
    return profiles(spark, d).select("profile", F.round(gb, 6).alias("memory_gb"), F.round(mb, 4).alias("training_mb"))


@query("F17_named_gpu_cost", f"""WITH {PROFILE_SQL}, named AS (SELECT s.*, CASE WHEN p_brand = 'Brand#1' THEN 'H100' WHEN p_brand = 'Brand#2' THEN 'T4' ELSE p_brand END AS wanted
        FROM sized s JOIN part ON profile = p_partkey),
    k AS (SELECT n.*, coalesce(g.gpu, 'A10G') AS priced_gpu FROM named n LEFT JOIN gpus g ON g.gpu = wanted)
    SELECT profile, priced_gpu, round(steps / (spm * greatest(0.5::DOUBLE, least(2.0::DOUBLE, 200.0::DOUBLE / params_m)) * 60) * 1.1::DOUBLE * price, 6) AS cost
    FROM k JOIN gpus ON gpus.gpu = priced_gpu""")
def f17(spark, d):
    brand = F.col("p_brand")
    named = profiles(spark, d).withColumn("gpu", F.when(brand == "Brand#1", "H100").when(brand == "Brand#2", "T4").otherwise(brand))
    return rounded(L.priced_on_named_gpu(named, 30.0).select("profile", "priced_gpu", "cost"), "cost")


@query("F18_budget_warning", f"""WITH {PROFILE_SQL} SELECT profile, gpu, CASE WHEN NOT cost <= 30.0::DOUBLE * 0.9::DOUBLE - spent
    THEN printf('Cost $%.2f exceeds safety margin. Only $%.2f available (90%% of budget).', cost, 30.0::DOUBLE * 0.9::DOUBLE - spent)
    WHEN (spent + cost) / 30 * 100 > 80 THEN printf('Warning: This will use %.1f%% of monthly budget.', (spent + cost) / 30 * 100) END AS warning FROM sweep""")
def f18(spark, d):
    return L.cost_sweep(profiles(spark, d), 30.0).select("profile", "gpu", "warning")


@query("O03_recommended_gpu", f"""WITH {PROFILE_SQL} SELECT profile, coalesce(arg_min(gpu, gpu_order) FILTER (WHERE cost <= 30.0::DOUBLE * 0.9::DOUBLE - spent), 'T4') AS gpu
    FROM sweep GROUP BY profile""")
def o03(spark, d):
    return L.recommended_gpu(L.cost_sweep(profiles(spark, d), 30.0), "profile")


# ---------------------------------------------------------------- sessions and curricula


def line_runs(spark, d) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "O", "running").otherwise("completed")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("session_id"), status.alias("status"), F.col("l_partkey").alias("steps"),
        F.col("l_suppkey").alias("tokens"), F.col("l_extendedprice").alias("cost"), F.col("l_quantity").alias("hours"), "l_linenumber",
    )


LINE_STATUS_SQL = "CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'O' THEN 'running' ELSE 'completed' END"


@query("A09_session_rollup", f"""WITH r AS (SELECT l_orderkey AS session_id, {LINE_STATUS_SQL} AS status, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM lineitem),
    t AS (SELECT session_id, sum(l_partkey)::BIGINT AS total_steps, sum(l_suppkey)::BIGINT AS total_tokens, sum(l_extendedprice) AS total_cost, sum(l_quantity) AS total_hours,
        count(*) AS runs, CASE WHEN bool_and(status = 'completed') THEN 'completed' WHEN bool_or(status = 'failed') AND bool_or(status = 'completed') THEN 'partial'
        WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'running') THEN 'running' ELSE 'pending' END AS status FROM r GROUP BY session_id)
    SELECT o_orderkey AS session_id, coalesce(total_steps, 0) AS total_steps, coalesce(total_tokens, 0) AS total_tokens, round(coalesce(total_cost, 0), 2) AS total_cost,
        round(coalesce(total_hours, 0), 2) AS total_hours, coalesce(runs, 0) AS runs, coalesce(status, 'pending') AS status FROM orders LEFT JOIN t ON session_id = o_orderkey""")
def a09(spark, d):
    sessions = table(spark, d, "orders").select(F.col("o_orderkey").alias("session_id"))
    return rounded(L.session_rollup(line_runs(spark, d), sessions), "total_cost", "total_hours", digits=2)


@query("A14_curriculum_totals", f"""WITH r AS (SELECT l_orderkey AS curriculum, {LINE_STATUS_SQL} AS status, l_linenumber, l_partkey, l_quantity, l_extendedprice,
        CASE WHEN l_returnflag = 'N' THEN 'ckpt_' || l_partkey ELSE '' END AS checkpoint FROM lineitem)
    SELECT curriculum, sum(l_partkey)::BIGINT AS total_steps, round(sum(l_quantity), 2) AS total_hours, round(sum(l_extendedprice), 2) AS total_cost,
    CASE WHEN bool_or(status = 'failed') THEN CASE WHEN bool_or(status = 'completed') THEN 'partial' ELSE 'failed' END
        WHEN count(*) FILTER (WHERE status = 'completed') = 3 THEN 'completed' ELSE 'partial' END AS status,
    coalesce(max({{'o': l_linenumber, 'c': checkpoint}}) FILTER (WHERE checkpoint <> '').c, '') AS final_checkpoint FROM r GROUP BY curriculum""")
def a14(spark, d):
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linestatus") == "O", "running").otherwise("completed")
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("curriculum"), F.col("l_linenumber").alias("phase_order"), F.lit(3).alias("phases"), status.alias("status"),
        F.col("l_partkey").alias("steps"), F.col("l_quantity").alias("hours"), F.col("l_extendedprice").alias("cost"),
        F.when(F.col("l_returnflag") == "N", F.concat(F.lit("ckpt_"), "l_partkey")).otherwise("").alias("checkpoint"),
    )
    return rounded(L.curriculum_totals(rows), "total_hours", "total_cost", digits=2)


def phase_plan(spark, d) -> DataFrame:
    needs = F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("ckpt_"), "o_custkey"))
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("curriculum"), F.col("o_orderkey").cast("string").alias("phase"), needs.alias("requires_checkpoint")
    )


@query("J05_runnable_phases", """SELECT o_custkey AS curriculum, o_orderkey::VARCHAR AS phase FROM orders
    WHERE o_orderpriority = '1-URGENT' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def j05(spark, d):
    there = table(spark, d, "customer").filter("c_acctbal > 0").select(F.concat(F.lit("ckpt_"), "c_custkey").alias("checkpoint"))
    return L.runnable_phases(phase_plan(spark, d), there).select("curriculum", "phase")


def finished_phases(spark, d, flag: str) -> DataFrame:
    done = table(spark, d, "lineitem").filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").cast("string").alias("phase"))
    return phase_plan(spark, d).select("curriculum", "phase").join(done, "phase", "left_semi")


@query("J06_remaining_phases", """SELECT o_custkey AS curriculum, o_orderkey::VARCHAR AS phase FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def j06(spark, d):
    return L.remaining_phases(phase_plan(spark, d), finished_phases(spark, d, "A")).select("curriculum", "phase")


@query("U03_phase_states", """SELECT o_custkey AS curriculum, o_orderkey::VARCHAR AS phase, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') THEN 'skipped'
    WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'failed' ELSE 'pending' END AS state FROM orders""")
def u03(spark, d):
    failed = finished_phases(spark, d, "R").withColumn("status", F.lit("failed"))
    return L.phase_states(phase_plan(spark, d), finished_phases(spark, d, "A"), failed).select("curriculum", "phase", "state")


# ---------------------------------------------------------------- lineage


@query("A19_lineage", """WITH r AS (SELECT o_custkey AS tenant, o_orderkey AS ord, o_orderpriority AS dataset FROM orders)
    SELECT tenant, string_agg(dataset, ' -> ' ORDER BY ord) AS lineage, count(*) AS datasets FROM r GROUP BY tenant""")
def a19(spark, d):
    return L.lineage_strings(table(spark, d, "orders").select(
        F.col("o_custkey").alias("tenant"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("dataset")
    ))


@query("A19_dataset_summary", """SELECT o_custkey AS tenant, o_orderpriority AS dataset, count(*) AS trainings, min(o_totalprice) AS best_val_loss,
    sum(o_orderkey)::BIGINT AS steps FROM orders GROUP BY 1, 2""")
def a19_summary(spark, d):
    return L.dataset_summary(table(spark, d, "orders").select(
        F.col("o_custkey").alias("tenant"), F.col("o_orderpriority").alias("dataset"), F.col("o_totalprice").alias("best_val_loss"),
        F.col("o_orderkey").alias("steps"),
    ))


@query("J07_already_processed", """WITH c AS (SELECT conv_id, turn, role AS dataset, substr(sha256(text), 1, 16) AS fp FROM conversations),
    l AS (SELECT dataset, fp FROM c WHERE turn = 0) SELECT conv_id, turn FROM c WHERE EXISTS (SELECT 1 FROM l WHERE l.dataset = c.dataset AND l.fp = c.fp)""")
def j07(spark, d):
    requests = table(spark, d, "conversations").select(
        "conv_id", "turn", F.col("role").alias("dataset"), S.fingerprint(F.col("text")).alias("fingerprint")
    )
    return L.already_processed(requests, requests.filter("turn = 0").select("dataset", "fingerprint")).select("conv_id", "turn")


@query("J07_new_requests", """WITH c AS (SELECT conv_id, turn, role AS dataset, substr(sha256(text), 1, 16) AS fp FROM conversations),
    l AS (SELECT dataset, fp FROM c WHERE turn = 0) SELECT conv_id, turn FROM c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.dataset = c.dataset AND l.fp = c.fp)""")
def j07_new(spark, d):
    requests = table(spark, d, "conversations").select(
        "conv_id", "turn", F.col("role").alias("dataset"), S.fingerprint(F.col("text")).alias("fingerprint")
    )
    return L.already_processed(requests, requests.filter("turn = 0").select("dataset", "fingerprint"), seen=False).select("conv_id", "turn")


@query("W09_keep_last_checkpoints", """WITH b AS (SELECT o_orderpriority AS run_id, o_orderkey AS step, o_totalprice = min(o_totalprice) OVER (PARTITION BY o_orderpriority) AS is_best,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC) AS r FROM orders) SELECT run_id, step, r <= 3 OR is_best AS keep FROM b""")
def w09(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("step"), "o_totalprice")
    best = rows.groupBy("run_id").agg(F.min("o_totalprice").alias("_best"))
    return L.keep_last(rows.join(best, "run_id"), ["run_id"], "step", 3, F.col("o_totalprice") == F.col("_best")).select("run_id", "step", "keep")


@query("W09_keep_last_lineage", """SELECT o_custkey AS tenant, o_orderkey AS ord, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) <= 3 AS keep FROM orders""")
def w09_lineage(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("tenant"), F.col("o_orderkey").alias("ord"))
    return L.keep_last(rows, ["tenant"], "ord", 3)


# ---------------------------------------------------------------- checkpoints

LISTING_SQL = """listing AS (SELECT '/runs/run_' || l_suppkey || '/checkpoint_step_' || CASE WHEN l_returnflag = 'R' THEN 'final' ELSE l_partkey::VARCHAR END || '.pt' AS path,
    l_suppkey, l_partkey, l_returnflag FROM lineitem)"""


def listing(spark, d) -> DataFrame:
    step = F.when(F.col("l_returnflag") == "R", "final").otherwise(F.col("l_partkey").cast("string"))
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("/runs/run_"), "l_suppkey", F.lit("/checkpoint_step_"), step, F.lit(".pt")).alias("path"),
        "l_partkey", "l_linestatus", F.col("l_shipdate").cast("timestamp_ntz").alias("modificationTime"),
    )


@query("S12_checkpoint_inventory", f"""WITH {LISTING_SQL} SELECT 'run_' || l_suppkey AS run_id, l_partkey::BIGINT AS step, count(*) AS files
    FROM listing WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def s12(spark, d):
    return L.parse_inventory(listing(spark, d)).groupBy("run_id", F.col("step").cast("bigint").alias("step")).agg(F.count(F.lit(1)).alias("files"))


@query("F23_step_of_file", f"WITH {LISTING_SQL} SELECT path, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS step, count(*) AS n FROM listing GROUP BY 1, 2")
def f23(spark, d):
    rows = listing(spark, d).withColumn("step", X.step_of_file(F.col("path")).cast("bigint"))
    return rows.groupBy("path", "step").agg(F.count(F.lit(1)).alias("n"))


@query("F22_path_slug", r"""SELECT url, replace(replace(url, '/', '_'), chr(92), '_') AS slug FROM pages""")
def f22(spark, d):
    return table(spark, d, "pages").select("url", X.path_slug(F.col("url")).alias("slug"))


@query("F26_base64", "SELECT item_id, base64(encode(text)) AS b64, length(text)::BIGINT AS chars FROM benchmark")
def f26(spark, d):
    coded = table(spark, d, "benchmark").select("item_id", F.base64(F.encode("text", "UTF-8")).alias("b64"))
    return coded.select("item_id", F.regexp_replace("b64", "[\r\n]", "").alias("b64"), F.length(F.decode(F.unbase64("b64"), "UTF-8")).cast("bigint").alias("chars"))


@query("O01_newest_usable", """SELECT 'run_' || l_suppkey AS run_id, max(l_partkey)::BIGINT AS step FROM lineitem
    WHERE l_returnflag <> 'R' AND l_linestatus = 'O' GROUP BY 1""")
def o01(spark, d):
    rows = L.parse_inventory(listing(spark, d)).withColumn("compatible", F.col("l_linestatus") == "O")
    return L.newest_usable(rows).select("run_id", F.col("step").cast("bigint").alias("step"))


@query("O04_newest_file", """WITH l AS (SELECT 'run_' || l_suppkey AS run_id, l_shipdate AS t, '/runs/run_' || l_suppkey || '/checkpoint_step_' || l_partkey || '.pt' AS path
    FROM lineitem WHERE l_returnflag <> 'R') SELECT run_id, max({'t': t, 'p': path}).p AS path FROM l GROUP BY run_id""")
def o04(spark, d):
    return L.newest_file(L.parse_inventory(listing(spark, d)))


@query("W10_next_version", """SELECT p_brand AS model, max(p_partkey) FILTER (WHERE p_type <> 'PROMO')::BIGINT AS highest,
    (coalesce(max(p_partkey) FILTER (WHERE p_type <> 'PROMO'), 0) + 1)::BIGINT AS next_version FROM part GROUP BY p_brand""")
def w10(spark, d):
    name = F.when(F.col("p_type") == "PROMO", F.lit("best_model.pt")).otherwise(F.concat(F.lit("best_model_v"), "p_partkey", F.lit(".pt")))
    files = table(spark, d, "part").select(F.col("p_brand").alias("model"), F.concat(F.lit("/models/"), "p_brand", F.lit("/"), name).alias("path"))
    return L.next_versions(files).select("model", *[F.col(c).cast("bigint").alias(c) for c in ("highest", "next_version")])


@query("P09_checkpoint_metadata", """SELECT o_orderkey AS checkpoint_id, CASE WHEN o_orderstatus = 'P' THEN o_custkey WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_orderkey END AS step,
    CASE WHEN o_orderstatus = 'P' THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS epoch, CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END AS train_loss,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN o_totalprice / 2 END AS val_loss, 0.001::DOUBLE AS learning_rate,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END AS timestamp, o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' AS is_best FROM orders""")
def p09(spark, d):
    inner = F.when(F.col("o_orderstatus") == "P", F.struct(
        F.col("o_custkey").alias("step"), F.lit(0.5).alias("epoch"), F.col("o_totalprice").alias("train_loss"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice") / 2).alias("val_loss"), F.lit(None).cast("double").alias("learning_rate"),
        F.col("o_orderpriority").alias("timestamp"), F.lit(None).cast("string").alias("dataset_hash"),
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit(True)).alias("is_best"),
    ))
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("checkpoint_id"), inner.alias("metadata"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("step"), F.lit(1.5).alias("epoch"), F.lit(0.001).alias("learning_rate"),
    )
    return L.normalised_metadata(raw).drop("dataset_hash")


# Stored order totals against the sum of the order's lines: present on one side, or different.
DIFF_SQL = """a AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders), b AS (SELECT l_orderkey AS k, max(l_partkey) AS v FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
    diff AS (SELECT coalesce(a.k, b.k) AS o_orderkey, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' WHEN a.v <> b.v THEN 'mismatch' END AS kind
    FROM a FULL JOIN b ON a.k = b.k)"""


def line_snapshot(spark, d) -> tuple[DataFrame, DataFrame]:
    current = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("v"))
    stored = table(spark, d, "lineitem").filter("l_returnflag <> 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_partkey").alias("v"))
    return current, stored


@query("J08_snapshot_diff", f"WITH {DIFF_SQL} SELECT o_orderkey, kind FROM diff WHERE kind IS NOT NULL")
def j08(spark, d):
    return L.snapshot_diff(*line_snapshot(spark, d), "o_orderkey", "v")


@query("J08_diff_report", f"""WITH {DIFF_SQL} SELECT count(*) FILTER (WHERE kind = 'missing') AS missing, count(*) FILTER (WHERE kind = 'unexpected') AS unexpected,
    count(*) FILTER (WHERE kind = 'mismatch') AS mismatch,
    coalesce((SELECT string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM diff WHERE kind = 'missing' ORDER BY 1 LIMIT 3)), '') AS missing_sample,
    coalesce((SELECT string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM diff WHERE kind = 'unexpected' ORDER BY 1 LIMIT 3)), '') AS unexpected_sample,
    coalesce((SELECT string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM diff WHERE kind = 'mismatch' ORDER BY 1 LIMIT 3)), '') AS mismatch_sample,
    count(kind) = 0 AS compatible FROM diff""")
def j08_report(spark, d):
    return L.diff_report(L.snapshot_diff(*line_snapshot(spark, d), "o_orderkey", "v"), "o_orderkey")


@query("U02_key_difference", """SELECT k, side FROM (SELECT o_orderkey AS k, 'ledger' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
    UNION ALL SELECT DISTINCT l_orderkey, 'lines' FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders))""")
def u02(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    b = table(spark, d, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("k")).distinct()
    return L.key_difference(a, b, "k", "ledger", "lines")


def config_values(spark, d, shift: bool) -> DataFrame:
    names = {"d_model": "d_model", "n_heads" if shift else "num_heads": "num_layers", "vocab_size": "vocab_size", "max_seq_len" if shift else "max_seq_length": "seq_len"}
    grow = F.when(F.col("p_brand") == "Brand#3", 64).otherwise(0) if shift else F.lit(0)
    wide = profiles(spark, d).withColumn("d_model", F.col("d_model") + grow).withColumn(
        "seq_len", F.when(F.col("p_brand") == "Brand#4", 512).otherwise(F.col("seq_len")) if shift else F.col("seq_len")
    )
    renamed = wide.select(F.col("profile").alias("run_id"), *[F.col(c).cast("bigint").alias(n) for n, c in names.items()])
    return renamed.unpivot(["run_id"], list(names), "name", "value")


@query("J09_config_mismatches", """SELECT p_partkey AS run_id, 'd_model' AS name, (128 * (1 + p_size // 8) + 64)::BIGINT AS stored, (128 * (1 + p_size // 8))::BIGINT AS wanted FROM part WHERE p_brand = 'Brand#3'
    UNION ALL SELECT p_partkey, 'max_seq_length', 512::BIGINT, 256::BIGINT FROM part WHERE p_brand = 'Brand#4'""")
def j09(spark, d):
    return L.config_mismatches(config_values(spark, d, True), config_values(spark, d, False))


# ---------------------------------------------------------------- configurations and checks


def run_configs(spark, d) -> DataFrame:
    size = F.col("p_size")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("run_id"), (F.col("p_type") != "PROMO").alias("has_model"), F.lit(True).alias("has_training"), F.lit(True).alias("has_hardware"),
        F.when(F.col("p_brand") == "Brand#5", "custom").otherwise("base").alias("architecture"), F.lit(384).alias("d_model"), size.alias("num_heads"),
        (size % 7).alias("kv_heads"), (size * 32).alias("d_ff"), (size > 25).alias("grouped_query"), (F.col("p_retailprice") / 1000 - 0.5).alias("dropout"),
        (F.col("p_retailprice") / 2000).alias("attention_dropout"), (F.lit(1.5) - F.col("p_retailprice") / 1000).alias("residual_dropout"),
        F.when(size % 5 > 0, size * 100).alias("vocab_size"), F.when(F.col("p_brand") != "Brand#2", 6).alias("num_layers"),
    )


CHECKS_SQL = """c AS (SELECT p_partkey AS run_id, p_size AS h, p_size % 7 AS kv, p_size * 32 AS f, p_size > 25 AS g, p_retailprice / 1000 - 0.5::DOUBLE AS dr, p_retailprice / 2000 AS ad, 1.5::DOUBLE - p_retailprice / 1000 AS rd, p_type, p_brand FROM part),
    checks AS (SELECT run_id, unnest(['sections', 'model_keys', 'architecture', 'head_dimensions', 'feed_forward', 'kv_groups', 'kv_heads', 'dropout', 'attention_dropout', 'residual_dropout']) AS check_name,
        unnest([p_type <> 'PROMO', h % 5 > 0 AND p_brand <> 'Brand#2', p_brand <> 'Brand#5', 384 % h = 0, f >= 384, NOT g OR (kv > 0 AND h % nullif(kv, 0) = 0), NOT g OR kv <= h, dr >= 0 AND dr <= 1, ad >= 0 AND ad <= 1, rd >= 0 AND rd <= 1]) AS ok,
        unnest(['CRITICAL', 'CRITICAL', 'ERROR', 'ERROR', 'ERROR', 'ERROR', 'ERROR', 'WARNING', 'WARNING', 'WARNING']) AS bad FROM c),
    rows_of AS (SELECT run_id, check_name, coalesce(ok, false) AS passed, CASE WHEN coalesce(ok, false) THEN 'INFO' ELSE bad END AS level FROM checks)"""


@query("P11_rule_checks", f"WITH {CHECKS_SQL} SELECT run_id, check_name, passed, level FROM rows_of")
def p11(spark, d):
    return L.rule_checks(run_configs(spark, d))


@query("A13_check_rollup", f"""WITH {CHECKS_SQL} SELECT run_id, count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
    count(*) FILTER (WHERE level = 'WARNING') AS warnings, NOT bool_or(NOT passed AND level IN ('ERROR', 'CRITICAL')) AS can_proceed FROM rows_of GROUP BY run_id""")
def a13(spark, d):
    return L.check_rollup(L.rule_checks(run_configs(spark, d)))


def nested_configs(spark, d) -> DataFrame:
    """Nested run records as JSON text, parsed with the record schema; many fields are missing."""
    part = table(spark, d, "part")
    promo = F.col("p_type") == "PROMO"
    phase = F.struct(F.col("p_name").alias("dataset"), F.when(~promo, F.col("p_size").cast("bigint") * 10).alias("training_steps"), (F.col("p_retailprice") / 100).alias("estimated_cost_usd"))
    record = F.struct(
        F.when(~promo, F.struct(F.struct(F.col("p_size").alias("embedding_dimension")).alias("dimensions"))).alias("model_architecture"),
        F.struct(F.struct(F.col("p_name").alias("name")).alias("training_dataset")).alias("dataset_configuration"),
        F.struct(F.create_map(F.lit("phase_1_foundation"), phase, F.lit("extra_phase"), phase).alias("training_phases")).alias("budget_configuration"),
    )
    text = part.select(F.col("p_partkey").alias("run_id"), F.to_json(record).alias("json"))
    return text.select("run_id", F.from_json("json", L.run_config_schema()).alias("r")).select("run_id", "r.*")


@query("P10_flat_run_config", """SELECT p_partkey AS run_id, (CASE WHEN p_type = 'PROMO' THEN 768 ELSE p_size END)::BIGINT AS d_model, 50000::BIGINT AS vocab_size,
    0.1::DOUBLE AS dropout, p_name AS dataset, 'A10G' AS gpu_type, 30.0::DOUBLE AS monthly_budget FROM part""")
def p10(spark, d):
    flat = L.flat_run_config(nested_configs(spark, d))
    return flat.select("run_id", F.col("d_model").cast("bigint").alias("d_model"), F.col("vocab_size").cast("bigint").alias("vocab_size"), "dropout", "dataset", "gpu_type", "monthly_budget")


@query("P10_config_phases", """SELECT p_partkey AS run_id, k AS phase_key, CASE k WHEN 'extra_phase' THEN 'Extra Phase' ELSE 'Foundation' END AS name,
    CASE k WHEN 'extra_phase' THEN 'extra_phase' ELSE 'foundation' END AS phase, p_name AS dataset, (CASE WHEN p_type = 'PROMO' THEN 10000 ELSE p_size * 10 END)::BIGINT AS max_steps,
    round(p_retailprice / 100, 6) AS estimated_cost, CASE k WHEN 'extra_phase' THEN 'extra_phase.pt' ELSE 'foundation_checkpoint.pt' END AS checkpoint_name
    FROM (SELECT *, unnest(['phase_1_foundation', 'extra_phase']) AS k FROM part)""")
def p10_phases(spark, d):
    out = L.config_phases(nested_configs(spark, d))
    return rounded(out.select("run_id", "phase_key", "name", "phase", "dataset", "max_steps", "estimated_cost", "checkpoint_name"), "estimated_cost")


# ---------------------------------------------------------------- ledger files and appends

LEDGER_SQL = "SELECT o_custkey::VARCHAR AS tenant, count(*) AS records, round(sum(o_totalprice), 2) AS cost_usd FROM orders GROUP BY 1"


@query("S10_ledger_source", LEDGER_SQL)
def s10(spark, d):
    record = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("o_orderpriority").alias("dataset"), F.lit("A10G").alias("gpu_type"),
        F.lit(1.0).alias("duration_hours"), F.col("o_totalprice").alias("cost_usd"), F.col("o_orderkey").alias("steps_trained"), F.lit(None).cast("string").alias("phase"),
    )
    out = scratch(spark, "s10")
    writers.write_documents(orders(spark, d).select(
        F.col("o_custkey").cast("string").alias("tenant"), F.lit(30.0).alias("monthly_budget"), F.array(record).alias("history")
    ), out)
    records = readers.ledger_records(readers.read_ledger(spark, out, "spend", multiline=False), "spend")
    return records.groupBy("tenant").agg(F.count(F.lit(1)).alias("records"), F.round(F.sum("cost_usd"), 2).alias("cost_usd"))


# A run of each order: every field of the record is set from its columns, written as JSON and read back.
RUN_SQL = """SELECT 'run_' || o_orderkey AS run_id, o_orderpriority AS phase, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' ELSE 'running' END AS status,
    o_custkey AS vocab_size, round(o_totalprice / 100, 6) AS final_loss, 2 * o_custkey AS steps_completed, round(o_totalprice, 6) AS actual_cost, 0.5::DOUBLE AS utilization,
    o_orderpriority || ',' || o_orderstatus AS tags, 16 + 15 + 23 + 6 + 6 AS fields_set FROM orders"""


def run_record(field, i: int):
    """A value of the field's type that follows from the order."""
    kind = field.dataType.simpleString()
    if kind == "string":
        return F.concat(F.lit(f"{field.name}_"), F.col("o_orderkey").cast("string"))
    if kind == "boolean":
        return F.col("o_orderkey") % 2 == 0
    if kind == "array<double>":
        return F.array(F.lit(1.0), F.col("o_totalprice"))
    if kind == "array<string>":
        return F.array("o_orderpriority", "o_orderstatus")
    return (F.col("o_custkey") * i).cast(kind) if kind == "bigint" else F.lit(0.5)


@query("S10_run_record", RUN_SQL)
def s10_runs(spark, d):
    schema, rows, out = T.StructType.fromDDL(readers.RUN), orders(spark, d), scratch(spark, "s10-runs")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "pending").otherwise("running")
    own = {
        "run_id": F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")), "phase": F.col("o_orderpriority"), "status": status,
        "final_loss": F.col("o_totalprice") / 100, "vocab_size": F.col("o_custkey").cast("bigint"), "steps_completed": F.col("o_custkey") * 2, "actual_cost": F.col("o_totalprice"),
    }
    value = lambda f: own.get(f.name, run_record(f, 3)).alias(f.name)
    fields = [F.struct(*map(value, f.dataType)).alias(f.name) if isinstance(f.dataType, T.StructType) else value(f) for f in schema]
    writers.write_documents(rows.select(*fields), out)
    back = readers.read_ledger(spark, out, "run_result", multiline=False)
    leaves = [f"{f.name}.{g.name}" if g else f.name for f in schema for g in (f.dataType if isinstance(f.dataType, T.StructType) else [None])]
    given = functools.reduce(operator.add, [F.col(c).isNotNull().cast("int") for c in leaves])
    return back.select(
        "run_id", "phase", "status", "config.vocab_size", F.round("metrics.final_loss", 6).alias("final_loss"), "metrics.steps_completed",
        F.round("cost.actual_cost", 6).alias("actual_cost"), F.col("resources.gpu_utilization_pct").alias("utilization"), F.array_join("tags", ",").alias("tags"), given.alias("fields_set"),
    )


@query("S11_ledger_sink", "SELECT o_orderpriority AS phase, count(*) AS records, round(sum(o_totalprice), 2) AS cost FROM orders GROUP BY 1")
def s11(spark, d):
    out = scratch(spark, "s11")
    rows = orders(spark, d).select(F.col("o_orderpriority").alias("phase"), F.col("o_totalprice").alias("cost"), "o_orderstatus")
    for status in ("P", "O", "F"):
        writers.append_records(rows.filter(F.col("o_orderstatus") == status).drop("o_orderstatus"), out, ["phase"])
    return spark.read.parquet(out).groupBy("phase").agg(F.count(F.lit(1)).alias("records"), F.round(F.sum("cost"), 2).alias("cost"))


@query("U01_append_records", """SELECT k, side FROM (SELECT o_orderkey AS k, 'spend' AS side FROM orders UNION ALL SELECT event_id, 'log' FROM events)""")
def u01(spark, d):
    spent = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("spend").alias("side"))
    logged = table(spark, d, "events").select(F.lit("log").alias("side"), F.col("event_id").alias("k"))
    return L.appended(spent, logged)


# ---------------------------------------------------------------- streams


@query("T01_stream_ingest", RECORDS_SQL)
def t01(spark, d):
    rules = learnt(spark, d)
    source = table(spark, d, "documents")
    out = scratch(spark, "t01")
    jobs.ingest(jobs.corpus_stream(spark, f"{d}/documents*.parquet", source.schema, "doc_id"), rules, 256, out)
    ids = F.array_join(F.transform("input_ids", lambda i: i.cast("string")), ",")
    return spark.read.parquet(out).select("doc_id", F.size("input_ids").cast("bigint").alias("length"), F.md5(ids.cast("binary")).alias("digest"))


@query("T02_stream_cap", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 700")
def t02(spark, d):
    schema = table(spark, d, "documents").schema
    out = scratch(spark, "t02")
    drain(jobs.corpus_stream(spark, f"{d}/documents*.parquet", schema, "doc_id"), jobs.capped(out, "doc_id", 700))
    return spark.read.parquet(f"{out}/rows").select("doc_id")


# Batches of a replayed stream, at most: their number must not grow with the files that the input happens to have.
BATCHES = 4


@query("T05_event_text", """SELECT conv_id AS request_id, 'complete' AS finish, string_agg(text, '' ORDER BY turn) AS text, count(*) AS tokens FROM conversations GROUP BY conv_id""")
def t05(spark, d):
    turns = table(spark, d, "conversations")
    tokens = turns.select(F.col("conv_id").alias("request_id"), F.col("turn").alias("seq"), F.lit("token").alias("kind"), "text")
    ends = turns.groupBy(F.col("conv_id").alias("request_id")).agg((F.max("turn") + 1).alias("seq")).select(
        "request_id", "seq", F.lit("complete").alias("kind"), F.lit(None).cast("string").alias("text")
    )
    source, out = scratch(spark, "t05-in"), scratch(spark, "t05")
    for part in (tokens, ends):  # an event a second; Spark takes the epoch itself for late
        part.withColumn("sent", F.timestamp_seconds(F.col("seq") + 1_000_000_000)).write.mode("append").parquet(source)
    files = files_per_batch(spark, source, BATCHES)
    stream = spark.readStream.schema(f"{jobs.EVENT_ROWS}, sent timestamp").option("maxFilesPerTrigger", files).parquet(source)
    done = assembled_requests(stream.withWatermark("sent", "1 hour"), "sent", patience=86_400_000)
    drain(done, lambda batch, n: put_batch(batch, out, n))
    return spark.read.schema(FINISHED).parquet(out).drop("batch_id")


@query("T05_ordered_text", "SELECT conv_id, string_agg(text, '|' ORDER BY turn) AS text, count(*) AS turns FROM conversations GROUP BY conv_id")
def t05_batch(spark, d):
    return concat_in_order(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "|", extra={"turns": F.count(F.lit(1))})


@query("T06_ledger_append", "SELECT o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m') AS month, o_totalprice AS cost FROM orders")
def t06(spark, d):
    rows = orders(spark, d).select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("cost"))
    source, out = scratch(spark, "t06-in"), scratch(spark, "t06")
    rows.write.mode("append").parquet(source)
    rows.filter("cost > 200000").write.mode("append").parquet(source)  # records sent again
    schema = "run_id bigint, ts timestamp_ntz, cost double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    drain(stream, jobs.ledger_append(out, "run_id", "ts", schema))
    return spark.read.parquet(out).select("run_id", F.col("month").cast("string").alias("month"), "cost")
