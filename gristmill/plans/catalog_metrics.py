"""Queries over step logs and scored candidates.

The `events` table stands in for the step log: a run is a user (many short runs) or an event
type (few runs that each hold a fifth of all rows). Steps are numbered in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import scalars as S
from gristmill.operators import metrics as M
from gristmill.operators import sampling as P
from gristmill.operators.blocks import positions
from gristmill.plans.registry import query, table
from gristmill.session import scratch
from gristmill.streaming import jobs
from gristmill.streaming.sinks import drain, latest

WARMUP, MAX_STEPS = 20, 1500


def lr_sql(step: str) -> str:
    part = f"least(({step} - {WARMUP}) / {float(MAX_STEPS - WARMUP)}::DOUBLE, 1.0::DOUBLE)"
    return (
        f"CASE WHEN {step} < {WARMUP} THEN 3e-4::DOUBLE * {step} / {WARMUP} ELSE "
        f"1e-5::DOUBLE + (3e-4::DOUBLE - 1e-5::DOUBLE) * 0.5::DOUBLE * (1 + cos({part} * 3.14159::DOUBLE)) END"
    )


def steps_sql(run: str) -> str:
    return f"""steps AS (SELECT *, {lr_sql('step')} AS lr FROM (SELECT {run}::VARCHAR AS run_id, row_number() OVER (PARTITION BY {run} ORDER BY ts, event_id) AS step,
        value / 100 AS loss, 5 + value / 10 AS step_time_ms, CASE WHEN value >= 10 THEN value / 50 END AS grad_norm FROM events))"""


def measured(rows: DataFrame) -> DataFrame:
    """Add the other step-log columns to rows with `step` and `value`."""
    return rows.select(
        "run_id", "step", (F.col("value") / 100).alias("loss"),
        S.expected_lr(F.col("step"), 3e-4, WARMUP, MAX_STEPS).alias("lr"),
        (5 + F.col("value") / 10).alias("step_time_ms"),
        F.when(F.col("value") >= 10, F.col("value") / 50).alias("grad_norm"),
        F.lit(32).alias("batch_size"), F.lit(1024).alias("seq_len"),
    )


def step_log(spark, d, run: str = "event_type") -> DataFrame:
    events = table(spark, d, "events").select(F.col(run).cast("string").alias("run_id"), "ts", "event_id", "value")
    hour = F.timestamp_diff("HOUR", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    return measured(positions(events, ["run_id"], ["ts", "event_id"], hour, "step"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


SUMMARY_SQL = """SELECT run_id, max(loss) FILTER (WHERE step = 1) AS initial_loss, arg_max(loss, step) AS final_loss, min(loss) AS best_loss,
    min({'l': loss, 's': step}).s AS best_step, round(exp(least(arg_max(loss, step), 10)), 6) AS final_perplexity,
    round(exp(least(min(loss), 10)), 6) AS best_perplexity, round(max(lr), 9) AS peak_lr, round(arg_max(lr, step), 9) AS final_lr,
    coalesce(max(grad_norm), 0) AS max_grad_norm, round(avg(grad_norm), 6) AS avg_grad_norm, round(avg(step_time_ms), 6) AS avg_step_time_ms,
    (count(*) * 32 * 1024)::BIGINT AS tokens, max(step) AS steps,
    round(CASE WHEN max(loss) FILTER (WHERE step = 1) > 0 THEN (1 - arg_max(loss, step) / max(loss) FILTER (WHERE step = 1)) * 100 ELSE 0 END, 6) AS improvement_pct
    FROM steps GROUP BY run_id"""


def tidy_summary(df: DataFrame) -> DataFrame:
    out = rounded(df, "final_perplexity", "best_perplexity", "avg_grad_norm", "avg_step_time_ms", "improvement_pct")
    return rounded(out, "peak_lr", "final_lr", digits=9)


@query("A05_run_summary", f"WITH {steps_sql('user_id')} {SUMMARY_SQL}")
def a05(spark, d):
    return tidy_summary(M.run_summary(step_log(spark, d, "user_id")))


@query("A05_run_summary_long_runs", f"WITH {steps_sql('event_type')} {SUMMARY_SQL}")
def a05_long(spark, d):
    return tidy_summary(M.run_summary(step_log(spark, d)))


@query("A06_mean_gradient_norm", f"WITH {steps_sql('event_type')} SELECT run_id, round(avg(grad_norm), 6) AS avg_grad_norm FROM steps GROUP BY run_id")
def a06(spark, d):
    return rounded(M.run_summary(step_log(spark, d)).select("run_id", "avg_grad_norm"), "avg_grad_norm")


@query("A07_validation_loss", f"""WITH {steps_sql('event_type')}, m AS (SELECT run_id, (step - 1) // 16 AS b, avg(loss) AS l FROM steps GROUP BY 1, 2)
    SELECT run_id, round(avg(l), 6) AS val_loss, count(*) AS batches FROM m GROUP BY run_id""")
def a07(spark, d):
    batches = step_log(spark, d).withColumn("batch_id", F.floor((F.col("step") - 1) / 16))
    return rounded(M.validation_loss(batches), "val_loss")


@query("A08_interval_mean", f"""WITH {steps_sql('event_type')} SELECT run_id, (step - 1) // 10 AS "interval", round(avg(loss), 6) AS avg_loss,
    round(count(*) * 32 * 1024 / (sum(step_time_ms) / 1000), 3) AS tokens_per_sec FROM steps GROUP BY 1, 2 HAVING count(*) = 10""")
def a08(spark, d):
    return rounded(rounded(M.interval_means(step_log(spark, d)), "avg_loss"), "tokens_per_sec", digits=3)


@query("A17_finite_scan", """SELECT event_type, bool_or(isnan(x)) AS has_nan, bool_or(isinf(x)) AS has_inf,
    coalesce(avg(x) FILTER (WHERE NOT isnan(x) AND NOT isinf(x)) > 2.5, false) AS warn
    FROM (SELECT event_type, CASE WHEN value < 0.02 THEN 'nan'::DOUBLE WHEN value > 400 THEN 'inf'::DOUBLE ELSE ln(value) END AS x FROM events) GROUP BY event_type""")
def a17(spark, d):
    value = F.col("value")
    x = F.when(value < 0.02, F.lit(float("nan"))).when(value > 400, F.lit(float("inf"))).otherwise(F.ln(value))
    return M.finite_scan(table(spark, d, "events").withColumn("x", x), ["event_type"], F.col("x"), warn_above=2.5)


@query("P06_thin_history", f"WITH {steps_sql('event_type')} SELECT run_id, step, loss FROM steps WHERE step % 100 = 0 OR step = 1")
def p06(spark, d):
    return M.thin_history(step_log(spark, d)).select("run_id", "step", "loss")


TAGS = {"train/loss": "loss", "train/lr": "lr", "train/tokens_per_sec": "tokens_per_sec", "val/loss": "val_loss"}


@query("S13_scalar_rows", f"""WITH {steps_sql('event_type')} SELECT run_id, step, tag, round(value, 6) AS value FROM (
    SELECT run_id, step, unnest(['train/loss', 'train/lr', 'train/tokens_per_sec', 'val/loss']) AS tag,
    unnest([loss, lr, 32768 / (step_time_ms / 1000), CASE WHEN step % 50 = 0 THEN loss END]) AS value FROM steps) WHERE value IS NOT NULL""")
def s13(spark, d):
    log = step_log(spark, d).withColumn("tokens_per_sec", 32768 / (F.col("step_time_ms") / 1000)).withColumn(
        "val_loss", F.when(F.col("step") % 50 == 0, F.col("loss"))
    )
    return rounded(M.scalar_rows(log, TAGS), "value")


@query("F13_perplexity", "SELECT event_id, round(exp(least(value / 10, 10)), 4) AS ledger, round(exp(least(value / 10, 20)), 2) AS loop FROM events")
def f13(spark, d):
    loss = F.col("value") / 10
    return table(spark, d, "events").select(
        "event_id", F.round(S.perplexity(loss, M.LEDGER_CAP), 4).alias("ledger"), F.round(S.perplexity(loss, M.LOOP_CAP), 2).alias("loop")
    )


@query("F14_expected_lr", f"WITH {steps_sql('event_type')} SELECT run_id, step, round(lr, 10) AS lr FROM steps")
def f14(spark, d):
    return rounded(step_log(spark, d).select("run_id", "step", "lr"), "lr", digits=10)


@query("F19_improvement", """SELECT o_orderkey, round(CASE WHEN a > 0 THEN (1 - o_totalprice / a) * 100 ELSE 0 END, 6) AS improvement_pct
    FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 200000.0::DOUBLE END AS a FROM orders)""")
def f19(spark, d):
    initial = F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(200000.0)
    return table(spark, d, "orders").select("o_orderkey", F.round(S.improvement_pct(initial, F.col("o_totalprice")), 6).alias("improvement_pct"))


@query("F21_throughput", """SELECT o_orderkey, round((o_orderkey - o_custkey) / nullif(s, 0), 6) AS steps_per_sec,
    round(coalesce((20000 - o_orderkey) / nullif((o_orderkey - o_custkey) / nullif(s, 0), 0) / 60, 0), 6) AS eta_min
    FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice / 100 END AS s FROM orders)""")
def f21(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("step"), F.col("o_custkey").alias("start"), F.lit(20000).alias("max_steps"),
        F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("o_totalprice") / 100).alias("elapsed"),
    )
    out = M.throughput(rows, "start", "elapsed", "max_steps")
    return rounded(out.select(F.col("step").alias("o_orderkey"), "steps_per_sec", "eta_min"), "steps_per_sec", "eta_min")


TRAILING_SQL = f"""{steps_sql('event_type')}, t AS (SELECT run_id, step, loss, avg(loss) OVER (PARTITION BY run_id ORDER BY step
    ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS avg_loss FROM steps)"""


@query("W05_trailing_mean", f"""WITH {TRAILING_SQL} SELECT run_id, step, round(avg_loss, 11) AS avg_loss,
    round(min(avg_loss) OVER (PARTITION BY run_id ORDER BY step), 11) AS best_avg FROM t""")
def w05(spark, d):
    return rounded(M.trailing_mean(step_log(spark, d)).select("run_id", "step", "avg_loss", "best_avg"), "avg_loss", "best_avg", digits=11)


@query("W06_best_so_far", f"""WITH {steps_sql('event_type')}, b AS (SELECT run_id, step, loss, min(loss) OVER (PARTITION BY run_id ORDER BY step
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM steps)
    SELECT run_id, step, best_before, coalesce(loss < best_before, true) AS is_best FROM b""")
def w06(spark, d):
    evals = step_log(spark, d).select("run_id", "step", F.col("loss").alias("val_loss"))
    return M.mark_best(evals).select("run_id", "step", "best_before", "is_best")


EVAL_EVERY, LOW, RATIO = 10, 0.5, 2.0
EARLY_STOP_SQL = f"""e AS (SELECT run_id, step, loss AS val, avg_loss AS train, row_number() OVER (PARTITION BY run_id ORDER BY step) AS k
        FROM t WHERE step % {EVAL_EVERY} = 0),
    f(run_id, k, best, waited, stop_step) AS (SELECT DISTINCT run_id, 0::BIGINT, NULL::DOUBLE, 0, NULL::BIGINT FROM e
        UNION ALL SELECT run_id, k, CASE WHEN better THEN val ELSE best END, w, CASE WHEN w >= 5 THEN step END FROM (
            SELECT *, CASE WHEN better THEN 0 ELSE waited + 1 END + CASE WHEN train < {LOW} AND val > train * {RATIO} THEN 1 ELSE 0 END AS w FROM (
            SELECT e.run_id, e.k, e.val, e.train, e.step, f.best, f.waited, f.best IS NULL OR f.best - e.val > 0.001 AS better
            FROM f JOIN e ON e.run_id = f.run_id AND e.k = f.k + 1 WHERE f.stop_step IS NULL)))"""


@query("W07_early_stop", f"""WITH RECURSIVE {TRAILING_SQL}, {EARLY_STOP_SQL}
    SELECT run_id, arg_max(best, k) AS best, arg_max(waited, k)::BIGINT AS waited, max(stop_step) AS stop_step FROM f GROUP BY run_id""")
def w07(spark, d):
    return M.early_stop(eval_log(spark, d), overfit_train=LOW, overfit_ratio=RATIO).withColumn("waited", F.col("waited").cast("bigint"))


def eval_log(spark, d, run: str = "event_type") -> DataFrame:
    means = M.smoothed_loss(step_log(spark, d, run))
    return means.filter(F.col("step") % EVAL_EVERY == 0).select(
        "run_id", (F.col("step") / EVAL_EVERY).cast("bigint").alias("eval_no"), "step",
        F.col("loss").alias("val_loss"), F.col("avg_loss").alias("train_loss"),
    )


@query("W07_early_stop_short_runs", f"""WITH RECURSIVE {TRAILING_SQL.replace('event_type', 'user_id')}, {EARLY_STOP_SQL}
    SELECT run_id, arg_max(best, k) AS best, arg_max(waited, k)::BIGINT AS waited, max(stop_step) AS stop_step FROM f GROUP BY run_id""")
def w07_short(spark, d):
    return M.early_stop(eval_log(spark, d, "user_id"), overfit_train=LOW, overfit_ratio=RATIO).withColumn("waited", F.col("waited").cast("bigint"))


STREAKS_SQL = """c AS (SELECT run_id, step FROM t WHERE avg_loss < 0.5 AND step > 50),
    i AS (SELECT run_id, step, step - row_number() OVER (PARTITION BY run_id ORDER BY step) AS island FROM c),
    s AS (SELECT run_id, min(step) AS start_step, count(*) AS length FROM i GROUP BY run_id, island)"""


@query("W08_overfit_streaks", f"WITH {TRAILING_SQL}, {STREAKS_SQL} SELECT run_id, start_step, length FROM s")
def w08_streaks(spark, d):
    means = M.smoothed_loss(step_log(spark, d)).select("run_id", "step", "avg_loss")
    return M.overfit_streaks(means, below=0.5, after_step=50)


@query("W08_overfit_stop", f"""WITH {TRAILING_SQL}, {STREAKS_SQL} SELECT run_id, min(start_step + 19) AS detect_step, min(start_step + 20) AS stop_step
    FROM s WHERE length >= 20 GROUP BY run_id""")
def w08(spark, d):
    return M.overfit_stop(w08_streaks(spark, d), limit=20)


@query("W11_step_time", f"""WITH {steps_sql('event_type')}, n AS (SELECT run_id, step, step_time_ms AS t,
    CASE WHEN step = 1 THEN 0 ELSE 1 + (step - 1) // 100 END AS n FROM steps)
    SELECT run_id, round(list_reduce(list({{'n': n, 't': t}} ORDER BY step), lambda a, x: {{'n': x.n, 't': (a.t * x.n + x.t) / (x.n + 1)}}).t, 6) AS step_time_ms,
    round(avg(t), 6) AS avg_step_time_ms FROM n GROUP BY run_id""")
def w11(spark, d):
    log = step_log(spark, d)
    mean = log.groupBy("run_id").agg(F.avg("step_time_ms").alias("avg_step_time_ms"))
    return rounded(M.blended_step_time(log).join(mean, "run_id"), "step_time_ms", "avg_step_time_ms")


@query("W12_progression", """WITH r AS (SELECT o_custkey AS dataset, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE 200000 END AS i, o_totalprice AS b FROM orders)
    SELECT dataset, pos, round((i - b) / i * 100, 6) AS improvement_pct, round(b - lag(b) OVER (PARTITION BY dataset ORDER BY pos), 6) AS change FROM r""")
def w12(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("dataset"), "o_orderkey", F.col("o_totalprice").alias("best_val_loss"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2).otherwise(200000.0).alias("initial_val_loss"),
    )
    placed = positions(rows, ["dataset"], ["o_orderkey"], F.floor(F.col("o_orderkey") / 100_000))
    return rounded(M.progression(placed, ["dataset"], "pos").select("dataset", "pos", "improvement_pct", "change"), "improvement_pct", "change")


@query("A05_quality_gate", f"""WITH {steps_sql('user_id')}, s AS ({SUMMARY_SQL})
    SELECT run_id, coalesce(improvement_pct >= 5 AND final_loss <= 3, false) AS passes FROM s""")
def gate(spark, d):
    return M.gate_runs(M.run_summary(step_log(spark, d, "user_id"))).select("run_id", F.coalesce("passes", F.lit(False)).alias("passes"))


# ---------------------------------------------------------------- scored candidates

SCORES_SQL = """scores AS (SELECT vec_id AS seq_id, (generate_subscripts(embedding, 1) - 1)::BIGINT AS token_id, unnest(embedding)::DOUBLE * 10 AS logit FROM embeddings),
    w AS (SELECT *, exp(logit / 0.8::DOUBLE - max(logit / 0.8::DOUBLE) OVER (PARTITION BY seq_id)) AS w FROM scores),
    soft AS (SELECT seq_id, token_id, logit, w / sum(w) OVER (PARTITION BY seq_id) AS prob FROM w)"""


def scores(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("seq_id"), F.posexplode("embedding").alias("token_id", "x")
    ).select("seq_id", F.col("token_id").cast("bigint").alias("token_id"), (F.col("x").cast("double") * 10).alias("logit"))


@query("F24_softmax", f"WITH {SCORES_SQL} SELECT seq_id, token_id, round(prob, 9) AS prob FROM soft")
def f24(spark, d):
    return rounded(P.softmax(scores(spark, d), 0.8).select("seq_id", "token_id", "prob"), "prob", digits=9)


@query("W13_top_k", f"""WITH {SCORES_SQL} SELECT seq_id, token_id FROM (SELECT *, rank() OVER (PARTITION BY seq_id ORDER BY logit DESC) AS r FROM scores) WHERE r <= 10""")
def w13(spark, d):
    return P.top_k(scores(spark, d), 10).select("seq_id", "token_id")


@query("W14_top_p", f"""WITH {SCORES_SQL}, k AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY seq_id ORDER BY logit DESC) AS r FROM scores) WHERE r <= 50),
    kw AS (SELECT *, exp(logit / 0.8::DOUBLE - max(logit / 0.8::DOUBLE) OVER (PARTITION BY seq_id)) AS w FROM k),
    ks AS (SELECT seq_id, token_id, w / sum(w) OVER (PARTITION BY seq_id) AS prob FROM kw),
    c AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY seq_id ORDER BY prob DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ks)
    SELECT seq_id, token_id, round(prob, 9) AS prob FROM c WHERE before <= 0.9""")
def w14(spark, d):
    kept = P.top_p(P.softmax(P.top_k(scores(spark, d), 50), 0.8), 0.9)
    return rounded(kept.select("seq_id", "token_id", "prob"), "prob", digits=9)


@query("F25_draw", f"""WITH {SCORES_SQL}, g AS (SELECT seq_id, token_id, ln(prob) - ln(-ln((CAST('0x' || substr(sha256('42:' || seq_id || ':' || token_id), 1, 13) AS BIGINT)
    + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)) AS g FROM soft) SELECT seq_id, arg_max(token_id, g) AS token_id FROM g GROUP BY seq_id""")
def f25(spark, d):
    return P.draw(P.softmax(scores(spark, d), 0.8))


@query("O05_greedy", f"WITH {SCORES_SQL} SELECT seq_id, -max({{'l': logit, 't': -token_id}}).t AS token_id FROM scores GROUP BY seq_id")
def o05(spark, d):
    return P.greedy(scores(spark, d))


# ---------------------------------------------------------------- streams

STREAM_SQL = f"""WITH steps AS (SELECT user_id::VARCHAR AS run_id, event_id + 1 AS step, value / 100 AS loss, 5 + value / 10 AS step_time_ms,
    CASE WHEN value >= 10 THEN value / 50 END AS grad_norm, {lr_sql('(event_id + 1)')} AS lr FROM events) {SUMMARY_SQL}"""


@query("T03_online_metrics", STREAM_SQL)
def t03(spark, d):
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events*.parquet").select(
        F.col("user_id").cast("string").alias("run_id"), (F.col("event_id") + 1).alias("step"), "value"
    )
    out = scratch(spark, "t03")
    drain(jobs.online_metrics(measured(events)), lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), "update")
    return tidy_summary(latest(spark, out, ["run_id"]))


@query("T04_run_monitor", f"""WITH RECURSIVE {TRAILING_SQL}, {EARLY_STOP_SQL}, {STREAKS_SQL},
    early AS (SELECT run_id, arg_max(best, k) AS best, max(stop_step) AS stop_step FROM f GROUP BY run_id),
    over AS (SELECT run_id, min(start_step + 19) AS detect_step FROM s WHERE length >= 20 GROUP BY run_id),
    n AS (SELECT run_id, max(step) AS last_step FROM steps GROUP BY run_id)
    SELECT run_id, last_step, best, stop_step, detect_step FROM n LEFT JOIN early USING (run_id) LEFT JOIN over USING (run_id)""")
def t04(spark, d):
    log = step_log(spark, d).select(
        "run_id", "step", "loss", F.when(F.col("step") % EVAL_EVERY == 0, F.col("loss")).alias("val_loss")
    )
    source, out = scratch(spark, "t04-in"), scratch(spark, "t04")
    log.repartition(4, "run_id", F.floor(F.col("step") / 64)).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    # Each run holds a fifth of the stream, so its steps are spread over tasks.
    drain(stream, jobs.monitor(
        out, eval_interval=EVAL_EVERY, streak=20, below=0.5, after_step=50, overfit_train=LOW, overfit_ratio=RATIO
    ))
    return jobs.monitor_state(spark, out).select("run_id", "last_step", "best", "stop_step", "detect_step")
