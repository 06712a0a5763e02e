"""Step-log and evaluation-log analytics of many runs.

A step log is `(run_id, step, loss, lr, step_time_ms, grad_norm, batch_size, seq_len)` with
steps 1, 2, ... per run; one run may hold a large share of all rows, so nothing here runs a
window over a whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.scalars import improvement_pct, perplexity
from gristmill.operators.blocks import running, sliding_mean, trailing
from gristmill.operators.earlystop import early_stop  # noqa: F401
from gristmill.session import joinable

BLOCK_STEPS = 100_000
# Perplexity caps of the ledger and of the training loop.
LEDGER_CAP, LOOP_CAP = 10.0, 20.0


def run_summary(log: DataFrame, *more: Column) -> DataFrame:
    """One row per run (and value of `more`, if given); ties for the best loss go to the earliest step."""
    final, best = F.max_by("loss", "step"), F.min("loss")
    initial = F.max(F.when(F.col("step") == 1, F.col("loss")))
    return log.groupBy("run_id", *more).agg(
        initial.alias("initial_loss"),
        final.alias("final_loss"),
        best.alias("best_loss"),
        F.min(F.struct("loss", "step"))["step"].alias("best_step"),
        perplexity(final, LEDGER_CAP).alias("final_perplexity"),
        perplexity(best, LEDGER_CAP).alias("best_perplexity"),
        F.max("lr").alias("peak_lr"),
        F.max_by("lr", "step").alias("final_lr"),
        F.coalesce(F.max("grad_norm"), F.lit(0.0)).alias("max_grad_norm"),
        F.avg("grad_norm").alias("avg_grad_norm"),
        F.avg("step_time_ms").alias("avg_step_time_ms"),
        F.sum(F.col("batch_size").cast("bigint") * F.col("seq_len")).alias("tokens"),
        F.max("step").alias("steps"),
    ).withColumn("improvement_pct", improvement_pct(F.col("initial_loss"), F.col("final_loss")))


def thin_history(log: DataFrame, every: int = 100) -> DataFrame:
    return log.filter((F.col("step") % every == 0) | (F.col("step") == 1))


def blended_step_time(log: DataFrame) -> DataFrame:
    """The blend (avg*n + t)/(n+1) where n counts only the thinned steps before each step.

    Folding it step by step gives step s the weight 1/(n_s+1) * prod_{u>s} n_u/(n_u+1).
    With n_u = 1 + floor((u-1)/100) for u > 1 the product has a closed logarithm, so the
    fold becomes one weighted sum.
    """
    def log_product(s: Column) -> Column:
        k = F.floor((s - 1) / 100)
        ratio = F.ln((k + 1) / (k + 2))
        return F.when(k == 0, (s - 1) * ratio).otherwise(
            -99 * F.ln(F.lit(2.0)) + 100 * (F.ln(F.lit(2.0)) - F.ln(k + 1)) + (s - 100 * k) * ratio
        )

    last = log.groupBy("run_id").agg(F.max("step").alias("_n"))
    before = F.when(F.col("step") == 1, F.lit(0)).otherwise(1 + F.floor((F.col("step") - 1) / 100))
    weight = F.exp(log_product(F.col("_n")) - log_product(F.col("step"))) / (before + 1)
    return log.join(joinable(last), "run_id").groupBy("run_id").agg(F.sum(F.col("step_time_ms") * weight).alias("step_time_ms"))


def validation_loss(losses: DataFrame) -> DataFrame:
    """Per run: unweighted mean of the batch means over `(run_id, batch_id, loss)`."""
    means = losses.groupBy("run_id", "batch_id").agg(F.avg("loss").alias("loss"))
    return means.groupBy("run_id").agg(F.avg("loss").alias("val_loss"), F.count(F.lit(1)).alias("batches"))


def interval_means(log: DataFrame, every: int = 10) -> DataFrame:
    """Mean loss and tokens/s of each full interval of `every` steps."""
    tokens = F.sum(F.col("batch_size").cast("bigint") * F.col("seq_len"))
    return (
        log.groupBy("run_id", F.floor((F.col("step") - 1) / every).cast("bigint").alias("interval"))
        .agg(
            F.avg("loss").alias("avg_loss"),
            F.try_divide(tokens.cast("double"), F.sum("step_time_ms") / 1000).alias("tokens_per_sec"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") == every).drop("_n")
    )


def smoothed_loss(log: DataFrame, width: int = 100) -> DataFrame:
    """Add `avg_loss` over the last `width` steps."""
    return sliding_mean(log, ["run_id"], "step", width, "loss", "avg_loss", BLOCK_STEPS)


def trailing_mean(log: DataFrame, width: int = 100) -> DataFrame:
    """Add `avg_loss` over the last `width` steps and `best_avg`, its running minimum."""
    with_mean = smoothed_loss(log, width)
    block = F.floor(F.col("step") / BLOCK_STEPS)
    return running(with_mean, ["run_id"], ["step"], block, {"best_avg": ("min", F.col("avg_loss"))})


def mark_best(evals: DataFrame) -> DataFrame:
    """Add `best_before` and `is_best`: strictly lower than every earlier value of the run."""
    block = F.floor(F.col("step") / BLOCK_STEPS)
    seen = running(
        evals, ["run_id"], ["step"], block, {"best_before": ("min_before", F.col("val_loss"))}
    )
    better = F.col("best_before").isNull() | (F.col("val_loss") < F.col("best_before"))
    return seen.withColumn("is_best", F.col("val_loss").isNotNull() & ~F.isnan("val_loss") & better)


def overfit_streaks(
    means: DataFrame, below: float = 1e-5, after_step: int = 500, state: DataFrame | None = None
) -> DataFrame:
    """`(run_id, start_step, length)` of consecutive steps whose trailing mean is below the bound.

    `means` is `(run_id, step, avg_loss)` with consecutive steps. `state` holds
    `(run_id, last_step, open_length)` of a streak that an earlier batch left open.
    """
    low = (F.col("avg_loss") < below) & (F.col("step") > after_step)
    block = F.floor(F.col("step") / BLOCK_STEPS)
    counted = running(means, ["run_id"], ["step"], block, {"_seen": ("sum", low.cast("bigint"))})
    streaks = (
        counted.filter(low).groupBy("run_id", (F.col("step") - F.col("_seen")).alias("_island"))
        .agg(F.min("step").alias("start_step"), F.count(F.lit(1)).alias("length")).drop("_island")
    )
    if state is None:
        return streaks
    joins = F.col("start_step") == F.col("last_step") + 1
    return streaks.join(state, "run_id", "left").select(
        "run_id",
        F.when(joins, F.col("start_step") - F.col("open_length")).otherwise(F.col("start_step")).alias("start_step"),
        F.when(joins, F.col("length") + F.col("open_length")).otherwise(F.col("length")).alias("length"),
    )


def overfit_stop(streaks: DataFrame, limit: int = 100) -> DataFrame:
    """First step at which a run's streak reaches `limit`, and the step after it."""
    return (
        streaks.filter(F.col("length") >= limit).groupBy("run_id")
        .agg(F.min(F.col("start_step") + limit - 1).alias("detect_step"))
        .withColumn("stop_step", F.col("detect_step") + 1)
    )


def progression(records: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Improvement of each record and the change against the record before it."""
    initial = F.col("initial_val_loss")
    gain = F.when(initial != 0, (initial - F.col("best_val_loss")) / initial * 100)
    with_last = trailing(records.withColumn("improvement_pct", gain), keys, pos, 2, {"_prev": F.first("best_val_loss")})
    change = F.when(F.col(pos) > 1, F.col("best_val_loss") - F.col("_prev"))
    return with_last.withColumn("change", change).drop("_prev")


def throughput(log: DataFrame, start_step: str, elapsed_s: str, max_steps: str) -> DataFrame:
    """Steps per second since the run (re)started, and the minutes left."""
    speed = F.try_divide((F.col("step") - F.col(start_step)).cast("double"), F.col(elapsed_s))
    left = F.try_divide((F.col(max_steps) - F.col("step")).cast("double"), speed) / 60
    return log.withColumn("steps_per_sec", speed).withColumn("eta_min", F.coalesce(left, F.lit(0.0)))


def scalar_rows(log: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """`(run_id, step, tag, value)` rows; `metrics` maps a tag to a column. NULLs are left out."""
    renamed = log.select("run_id", "step", *[F.col(c).cast("double").alias(tag) for tag, c in metrics.items()])
    return renamed.unpivot(["run_id", "step"], list(metrics), "tag", "value").filter(F.col("value").isNotNull())


def gate_runs(summary: DataFrame, min_improvement: float = 5.0, max_val_loss: float = 3.0) -> DataFrame:
    return summary.withColumn(
        "passes", (F.col("improvement_pct") >= min_improvement) & (F.col("final_loss") <= max_val_loss)
    )


def masked_mean(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Mean score over targets other than -1; NULL when all are ignored."""
    return scores.groupBy(*keys).agg(
        F.avg(F.when(F.col("target") != -1, F.col("score"))).alias("loss"),
        F.count_if(F.col("target") != -1).alias("targets"),
    )


def finite_scan(df: DataFrame, keys: list[str], value: Column, warn_above: float = 100.0) -> DataFrame:
    """Does a group hold a NaN or an infinity, and is the mean of its finite values suspicious?"""
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    return df.groupBy(*keys).agg(
        F.bool_or(F.isnan(value)).alias("has_nan"),
        F.bool_or(F.abs(value) == float("inf")).alias("has_inf"),
        F.coalesce(F.avg(F.when(~bad, value)) > warn_above, F.lit(False)).alias("warn"),
    )
