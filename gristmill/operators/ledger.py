"""Shared ledgers of runs, spend, schedules, lineage, checkpoints and checks.

The tables hold the records of many tenants, runs and corpora; one of them may own a large
share of the rows. Aggregations combine before the shuffle, ordered work runs in blocks.
Points in time are parameters (`as_of`), never the clock.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import scalars as S
from gristmill.functions.text import step_of_file, version_of_file
from gristmill.operators.blocks import positions, running
from gristmill.operators.gather import concat_in_order
from gristmill.session import broadcast_if_small, by_size, cut_lineage, joinable

# ---------------------------------------------------------------- spend


def in_current_month(ts: Column, as_of: Column) -> Column:
    return ts >= F.date_trunc("month", as_of).cast("timestamp_ntz")


def in_last_30_days(ts: Column, as_of: Column) -> Column:
    return ts >= as_of - F.expr("INTERVAL 30 DAYS")


def spend_summary(ledger: DataFrame, as_of: str, budget: float) -> DataFrame:
    """Per tenant over `(tenant, ts, cost)`: month, 30 days, all time, what is left."""
    now = F.lit(as_of).cast("timestamp_ntz")
    month = F.sum(F.when(in_current_month(F.col("ts"), now), F.col("cost")).otherwise(0.0))
    recent = F.sum(F.when(in_last_30_days(F.col("ts"), now), F.col("cost")).otherwise(0.0))
    return ledger.groupBy("tenant").agg(
        month.alias("current_month"), recent.alias("last_30_days"), F.sum("cost").alias("all_time"),
        F.count(F.lit(1)).alias("total_runs"),
        (budget - month).alias("remaining"), (budget * S.SAFETY_MARGIN - month).alias("remaining_safe"),
        (month / budget * 100).alias("utilization_pct"),
    )


def spend_by_phase(ledger: DataFrame) -> DataFrame:
    """`(tenant, phase, cost)`; records without a phase are left out."""
    return ledger.filter(F.col("phase") != "").groupBy("tenant", "phase").agg(F.sum("cost").alias("cost"))


def spend_map(by_phase: DataFrame) -> DataFrame:
    """`(tenant, by_phase MAP)`; a tenant has one entry per phase name."""
    entries = F.array_sort(F.collect_list(F.struct("phase", "cost")))
    return by_phase.groupBy("tenant").agg(F.map_from_entries(entries).alias("by_phase"))


def cost_sweep(profiles: DataFrame, budget: float) -> DataFrame:
    """Every profile on every GPU tier: hours, cost, batch fit and budget flags.

    Profiles carry `vocab_size, d_model, num_layers, d_ff, seq_len, max_steps, spent`. The
    five tiers are a literal array that is exploded, so nothing is joined.
    """
    swept = profiles.withColumn("_g", F.explode(S.gpu_specs_array())).select(
        "*", "_g.gpu", "_g.gpu_order", "_g.cost_per_hour", "_g.steps_per_minute", "_g.memory_gb"
    ).drop("_g")
    return priced(swept, budget)


def priced(rows: DataFrame, budget: float) -> DataFrame:
    """Add size, hours, cost and budget columns to rows that carry a tier's columns."""
    v, d, n, f = (F.col(c) for c in ("vocab_size", "d_model", "num_layers", "d_ff"))
    sized = rows.withColumn("params_m", S.params_millions(v, d, n, f)).withColumn(
        "batch", S.fitting_batch(v, d, n, f, F.col("seq_len"), F.col("memory_gb"))
    )
    timed = sized.withColumn("hours", S.estimated_hours(F.col("max_steps"), F.col("params_m"), F.col("steps_per_minute")))
    cost = timed.withColumn("cost", F.col("hours") * F.col("cost_per_hour"))
    return cost.withColumns(S.budget_columns(F.col("cost"), F.col("spent"), F.lit(budget)))


def priced_on_named_gpu(profiles: DataFrame, budget: float) -> DataFrame:
    """Price each profile on the tier it names in `gpu`; unknown names use the default tier."""
    spec = S.gpu_spec(F.col("gpu"))
    with_spec = profiles.withColumn("_g", spec).select(
        "*", F.col("_g.gpu").alias("priced_gpu"), "_g.cost_per_hour", "_g.steps_per_minute", "_g.memory_gb"
    ).drop("_g")
    return priced(with_spec, budget)


def recommended_gpu(sweep: DataFrame, key: str) -> DataFrame:
    """First tier, in fixed order, within the safety margin; the cheapest when none is.

    The least order alone is kept, which a hash aggregate can do; its tier's name follows from it.
    """
    first = sweep.groupBy(key).agg(F.min(F.when(F.col("within_safety"), F.col("gpu_order"))).alias("_order"))
    return first.select(key, F.coalesce(S.gpu_of_order(F.col("_order")), F.lit("T4")).alias("gpu"))


# ---------------------------------------------------------------- sessions and curricula


def session_rollup(runs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Totals and status per session; a session without runs is pending."""
    status = F.col("status")
    totals = runs.groupBy("session_id").agg(
        F.sum("steps").alias("total_steps"), F.sum("tokens").alias("total_tokens"),
        F.sum("cost").alias("total_cost"), F.sum("hours").alias("total_hours"),
        F.count(F.lit(1)).alias("runs"),
        F.bool_and(status == "completed").alias("_all"), F.bool_or(status == "completed").alias("_some"),
        F.bool_or(status == "failed").alias("_failed"), F.bool_or(status == "running").alias("_running"),
    )
    named = F.expr(
        "CASE WHEN _all THEN 'completed' WHEN _failed AND _some THEN 'partial' WHEN _failed THEN 'failed' "
        "WHEN _running THEN 'running' ELSE 'pending' END"
    )
    joined = sessions.select("session_id").join(totals, "session_id", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("total_steps", "total_tokens", "total_cost", "total_hours", "runs")}
    return joined.withColumn("status", named).withColumns(zero).drop("_all", "_some", "_failed", "_running")


def curriculum_totals(results: DataFrame) -> DataFrame:
    """Per curriculum over `(curriculum, phase_order, phases, status, steps, hours, cost, checkpoint)`.

    `phases` is the number of phases planned. Only phases completed in these results count,
    so a resumed curriculum reads partial.
    """
    done, failed = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    status = (
        F.when((failed > 0) & (done > 0), "partial").when(failed > 0, "failed")
        .when(done == F.max("phases"), "completed").otherwise("partial")
    )
    named = F.when(F.col("checkpoint") != "", F.struct("phase_order", "checkpoint"))
    return results.groupBy("curriculum").agg(
        F.sum("steps").alias("total_steps"), F.sum("hours").alias("total_hours"), F.sum("cost").alias("total_cost"),
        status.alias("status"), F.coalesce(F.max(named)["checkpoint"], F.lit("")).alias("final_checkpoint"),
    )


def runnable_phases(phases: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Phases that need no checkpoint or whose `requires_checkpoint` exists."""
    free = phases.filter(F.col("requires_checkpoint").isNull())
    have = checkpoints.select(F.col("checkpoint").alias("requires_checkpoint"))
    return free.unionByName(phases.join(have, "requires_checkpoint", "left_semi").select(*phases.columns))


def remaining_phases(phases: DataFrame, completed: DataFrame) -> DataFrame:
    return phases.join(completed, ["curriculum", "phase"], "left_anti")


def phase_states(phases: DataFrame, completed: DataFrame, outcome: DataFrame) -> DataFrame:
    """completed / failed / skipped / pending for each planned phase.

    Phases completed earlier are skipped; the others take the status of `outcome`.
    """
    before = completed.select("curriculum", "phase", F.lit(True).alias("_done")).distinct()
    now = outcome.select("curriculum", "phase", F.col("status").alias("_now"))
    state = F.when(F.col("_done"), "skipped").otherwise(F.coalesce("_now", F.lit("pending")))
    return (
        phases.join(before, ["curriculum", "phase"], "left").join(now, ["curriculum", "phase"], "left")
        .withColumn("state", state).drop("_done", "_now")
    )


# ---------------------------------------------------------------- schedule


def due_runs(schedule: DataFrame, as_of: str) -> DataFrame:
    return schedule.filter((F.col("status") == "pending") & (F.col("scheduled") <= F.lit(as_of).cast("timestamp_ntz")))


def schedule_counts(schedule: DataFrame) -> DataFrame:
    """Runs per status and tenant; a skipped run only counts in the total."""
    named = [F.count_if(F.col("status") == s).alias(s) for s in ("pending", "running", "completed", "failed")]
    return schedule.groupBy("tenant").agg(*named, F.count(F.lit(1)).alias("total"))


def recent_history(schedule: DataFrame, limit: int = 10) -> DataFrame:
    """Latest finished runs; a missing completion time sorts last."""
    done = schedule.filter(F.col("status").isin("completed", "failed"))
    return done.orderBy(F.coalesce(F.col("completed_at"), F.lit("")).desc(), "run_id").limit(limit)


# Rows of a dataset that one task takes as they are, and rows of many datasets that are dealt to one task.
WHOLE_DATASET, TASK_ROWS = 100_000, 500_000


def apply_events(
    ledger: DataFrame, events: DataFrame, block: Column, event_block: Column, whole: int = WHOLE_DATASET, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Fold start / complete / fail events into a ledger of pending runs.

    `ledger` is `(dataset, run_no)` and `events` is `(dataset, event_no, kind)`. A start hits
    the dataset's first pending run, an end its first running one; an event that finds no
    such run is lost. Starts therefore take runs in ledger order and ends finish them in the
    same order, so both are matched by their number. An end is lost exactly when the running
    count of starts minus ends falls to a new low below zero, so that low is also the number
    of ends lost so far.

    Datasets of up to `whole` runs and events are dealt to tasks, more tasks the more rows there are, and go through
    one sort. Only larger ones are cut into blocks, whose state is carried on by joins.
    """
    both = ledger.select("dataset", F.lit(0).alias("_tag")).unionByName(events.select("dataset", F.lit(1).alias("_tag")))
    sizes = both.filter(F.col("dataset").isNotNull()).groupBy("dataset").agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(sizes.filter(F.col("_n") > whole).select("dataset"))
    if large.isEmpty():
        return _apply_whole(ledger, events, task_rows)
    part = lambda rows, how: rows.join(broadcast_if_small(large), "dataset", how)
    cut = _apply_in_blocks(part(ledger, "left_semi"), part(events, "left_semi"), block, event_block)
    return _apply_whole(part(ledger, "left_anti"), part(events, "left_anti"), task_rows).unionByName(cut)


def _ended_as(end: Column, started: Column) -> Column:
    return F.when(end == "complete", "completed").when(end == "fail", "failed").when(started.isNotNull(), "running").otherwise("pending")


def _apply_whole(ledger: DataFrame, events: DataFrame, task_rows: int) -> DataFrame:
    """Each dataset in one task: its runs come first in the order, then its events."""
    kinds = ledger.schema["run_no"].dataType, events.schema["event_no"].dataType
    tag, kind = F.lit(None).cast("string"), F.col("kind")
    rows = ledger.select("dataset", "run_no", F.lit(None).cast(kinds[1]).alias("event_no"), tag.alias("kind"), F.lit(0).alias("_tag")).unionByName(
        events.filter(F.col("dataset").isNotNull() & kind.isNotNull()).select(
            "dataset", F.lit(None).cast(kinds[0]).alias("run_no"), "event_no", "kind", F.lit(1).alias("_tag"))
    )
    known = rows.filter(F.col("dataset").isNotNull())
    dealt = by_size(known, task_rows, "dataset")
    is_run, is_start = F.col("_tag") == 0, F.col("kind") == "start"
    here = W.partitionBy("dataset").orderBy("_tag", "run_no", "event_no")
    to_here, before = here.rowsBetween(W.unboundedPreceding, 0), here.rowsBetween(W.unboundedPreceding, -1)
    count = lambda which: F.sum(F.when(which, 1).otherwise(0)).over(to_here)
    counted = dealt.select(
        "*", count(is_run).alias("_runs"), count(is_start).alias("_starts"), count(~is_run & ~is_start).alias("_ends"),
    ).withColumn("_level", F.when(~is_run, F.least("_starts", "_runs") - F.col("_ends")))
    low = counted.withColumn("_low", F.min("_level").over(to_here)).withColumn("_low_before", F.min("_level").over(before))
    zero = F.lit(0)
    lost = F.when(is_run, False).when(is_start, F.col("_starts") > F.col("_runs")).otherwise(
        F.col("_level") < F.least(F.coalesce("_low_before", zero), zero)
    )
    number = F.when(is_run, F.col("_runs")).when(is_start, F.col("_starts")).otherwise(F.col("_ends") - F.greatest(zero, -F.col("_low")))
    # A run has one row, one start and one end at most; numbers stay in a hash aggregate, texts would be sorted.
    end = F.when(F.col("kind") == "complete", 2).when(F.col("kind") == "fail", 1).otherwise(0)
    folded = low.filter(~lost).withColumn("_k", number).groupBy("dataset", "_k").agg(
        F.max("run_no").alias("run_no"), F.max(F.when(is_start, F.col("event_no"))).alias("started_by"),
        F.max(F.when(~is_run & ~is_start, F.col("event_no"))).alias("ended_by"), F.max(F.when(~is_run & ~is_start, end)).alias("_end"),
    )
    ended = F.when(F.col("_end") == 2, "complete").when(F.col("_end") == 1, "fail")
    found = folded.select("dataset", "run_no", _ended_as(ended, F.col("started_by")).alias("status"), "started_by", "ended_by")
    unknown = ledger.filter(F.col("dataset").isNull()).select(
        "dataset", "run_no", F.lit("pending").alias("status"), F.lit(None).cast(kinds[1]).alias("started_by"), F.lit(None).cast(kinds[1]).alias("ended_by")
    )
    return found.unionByName(unknown)


def _apply_in_blocks(ledger: DataFrame, events: DataFrame, block: Column, event_block: Column) -> DataFrame:
    """Datasets of any size: their runs and events are cut into blocks."""
    runs = positions(ledger, ["dataset"], ["run_no"], block, "_k")
    have = ledger.groupBy("dataset").agg(F.count(F.lit(1)).alias("_runs"))
    is_start = F.col("kind") == "start"
    counted = running(events, ["dataset"], ["event_no"], event_block, {
        "_starts": ("sum", is_start.cast("bigint")), "_ends": ("sum", (~is_start).cast("bigint")),
    }).join(joinable(have), "dataset")
    level = F.least("_starts", "_runs") - F.col("_ends")
    low = running(counted.withColumn("_level", level), ["dataset"], ["event_no"], event_block, {
        "_low": ("min", F.col("_level")), "_low_before": ("min_before", F.col("_level")),
    })
    zero = F.lit(0)
    lost = F.when(is_start, F.col("_starts") > F.col("_runs")).otherwise(
        F.col("_level") < F.least(F.coalesce("_low_before", zero), zero)
    )
    lost_ends = F.greatest(zero, -F.col("_low"))
    ranked = low.filter(~lost).withColumn("_k", F.when(is_start, F.col("_starts")).otherwise(F.col("_ends") - lost_ends))
    folded = ranked.groupBy("dataset", "_k").agg(
        F.max(F.when(is_start, F.col("event_no"))).alias("started_by"),
        F.max(F.when(~is_start, F.struct("event_no", "kind"))).alias("_end"),
    )
    status = _ended_as(F.col("_end.kind"), F.col("started_by"))
    return runs.join(folded, ["dataset", "_k"], "left").select(
        "dataset", "run_no", status.alias("status"), "started_by", F.col("_end.event_no").alias("ended_by")
    )


def run_outcome(events: DataFrame) -> DataFrame:
    """Start, end, terminal status and duration per run over `(run_id, ts, kind)`.

    Kinds are start, complete, fail and cancel.
    """
    ended = F.max(F.when(F.col("kind") != "start", F.struct("ts", "kind")))
    names = {"complete": "completed", "fail": "failed", "cancel": "cancelled"}
    ended_as = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return events.groupBy("run_id").agg(
        F.min(F.when(F.col("kind") == "start", F.col("ts"))).alias("started_at"), ended.alias("_e")
    ).select(
        "run_id", "started_at", F.col("_e.ts").alias("completed_at"),
        F.coalesce(
            F.try_element_at(ended_as, F.col("_e.kind")), F.when(F.col("started_at").isNotNull(), "running"), F.lit("pending")
        ).alias("status"),
        S.duration_hours(F.col("started_at"), F.col("_e.ts")).alias("hours"),
    )


def affordable(due: DataFrame, budgets: DataFrame) -> DataFrame:
    """Add `accepted`: each due run, in ledger order, starts if its cost fits what is left.

    `due` is `(ledger, pos, cost)` and `budgets` `(ledger, remaining)`, costs being whole
    units (such as cents) and not negative. A skipped run uses nothing up, so a running sum
    is not enough: ledgers of any size go through rounds in which every ledger's remaining
    budget at least halves. A ledger without a budget, and a run without a cost, accept nothing.
    """
    known = budgets.filter(F.col("ledger").isNotNull() & F.col("remaining").isNotNull()).select(F.col("ledger").alias("_of"), "remaining")
    rows = due.join(known, F.col("ledger") == F.col("_of"), "left").drop("_of")
    able = F.col("remaining").isNotNull() & F.col("cost").isNotNull() & F.col("pos").isNotNull()
    gated = _halving_gate(rows.filter(able).select("ledger", "pos", "cost", "remaining")).select(
        F.col("ledger").alias("_of"), F.col("pos").alias("_at"), "accepted"
    )
    found = due.join(gated, (F.col("ledger") == F.col("_of")) & (F.col("pos") == F.col("_at")), "left").drop("_of", "_at")
    return found.withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def _halving_gate(rows: DataFrame, block: int = 50_000) -> DataFrame:
    """Large ledgers, in rounds that each settle a stretch `(start, end]` of every ledger.

    Within a round, runs costing at most half of what is left always fit until half is used
    up; the round ends there, or at the first dearer run that fits. Dearer runs before that
    point do not fit. Only the stretches are kept: one small row per ledger and round. What
    is left at least halves from round to round, so there are few.
    """
    base = cut_lineage(rows.select("ledger", "pos", "cost"))
    state = cut_lineage(rows.groupBy("ledger").agg(
        F.max("remaining").cast("bigint").alias("left"), (F.min("pos") - 1).alias("start")
    ))
    small = F.col("cost") * 2 <= F.col("left")
    stretches = []
    while not state.isEmpty():
        todo = base.join(broadcast_if_small(state), "ledger").filter((F.col("pos") > F.col("start")) & (F.col("cost") <= F.col("left")))
        placed = running(
            todo, ["ledger"], ["pos"], F.floor(F.col("pos") / block),
            {"_sum": ("sum", F.when(small, F.col("cost")).otherwise(F.lit(0)))},
        )
        used = F.col("_sum") + F.when(small, F.lit(0)).otherwise(F.col("cost"))
        ends = (F.col("left") > 0) & F.when(small, F.col("_sum") * 2 >= F.col("left")).otherwise(used <= F.col("left"))
        ending = placed.groupBy("ledger").agg(F.min(F.when(ends, F.struct(F.col("pos").alias("end"), used.alias("used")))).alias("_e"))
        done = cut_lineage(state.join(ending, "ledger", "left").select("ledger", "left", "start", "_e.end", "_e.used"))
        stretches.append(done.select("ledger", "left", "start", "end"))
        state = done.filter(F.col("end").isNotNull()).select(
            "ledger", (F.col("left") - F.col("used")).alias("left"), F.col("end").alias("start")
        )
    if not stretches:
        return base.select("ledger", F.col("pos").cast("bigint").alias("pos"), F.lit(True).alias("accepted"))
    every = stretches[0]
    for part in stretches[1:]:
        every = every.unionByName(part)
    per_ledger = every.groupBy("ledger").agg(F.collect_list(F.struct("left", "start", "end")).alias("_s"))
    mine = F.get(F.filter(
        "_s", lambda s: (F.col("pos") > s["start"]) & (s["end"].isNull() | (F.col("pos") <= s["end"]))
    ), F.lit(0))
    ok = (F.col("cost") * 2 <= F.col("_m.left")) | F.coalesce(F.col("pos") == F.col("_m.end"), F.lit(False))
    return base.join(joinable(per_ledger), "ledger").withColumn("_m", mine).select(
        "ledger", F.col("pos").cast("bigint").alias("pos"), ok.alias("accepted")
    )


# ---------------------------------------------------------------- lineage


def lineage_strings(records: DataFrame) -> DataFrame:
    """`(tenant, lineage, datasets)` over `(tenant, ord, dataset)`: names in training order."""
    return concat_in_order(
        records, ["tenant"], "ord", "dataset", " -> ", out="lineage", extra={"datasets": F.count(F.lit(1))}
    )


def dataset_summary(records: DataFrame) -> DataFrame:
    """Per tenant and dataset: trainings, best loss and total steps."""
    return records.groupBy("tenant", "dataset").agg(
        F.count(F.lit(1)).alias("trainings"), F.min("best_val_loss").alias("best_val_loss"), F.sum("steps").alias("steps")
    )


def already_processed(requests: DataFrame, lineage: DataFrame, seen: bool = True) -> DataFrame:
    """Requests whose (dataset, fingerprint) is (or is not) in the lineage ledger."""
    known = lineage.select("dataset", "fingerprint").distinct()
    return requests.join(known, ["dataset", "fingerprint"], "left_semi" if seen else "left_anti")


def keep_last(rows: DataFrame, keys: list[str], order: str, n: int, best: Column | None = None) -> DataFrame:
    """Add `keep`: the last `n` rows of each key by the unique `order`, and the best one.

    Only the cut value of each key is found with a window; Spark trims every task to `n`
    rows per key before that shuffle.
    """
    last = W.partitionBy(*keys).orderBy(F.desc(order))
    cut = (
        rows.select(*keys, order).withColumn("_r", F.row_number().over(last)).filter(F.col("_r") <= n)
        .groupBy(*keys).agg(F.min(order).alias("_cut"))
    )
    keep = F.col(order) >= F.col("_cut")
    if best is not None:
        keep = keep | F.coalesce(best, F.lit(False))
    return rows.join(joinable(cut), keys).withColumn("keep", keep).drop("_cut")


# ---------------------------------------------------------------- checkpoints


def parse_inventory(listing: DataFrame) -> DataFrame:
    """Checkpoints of a file listing: `run_id` is the folder, files without a step are left out."""
    parts = F.split("path", "/")
    return (
        listing.withColumn("name", F.element_at(parts, -1)).filter(F.col("name").rlike(r"^checkpoint_step_.*\.pt$"))
        .withColumn("run_id", F.get(parts, F.size(parts) - 2)).withColumn("step", step_of_file(F.col("path")))
        .filter(F.col("step").isNotNull())
    )


def newest_usable(checkpoints: DataFrame) -> DataFrame:
    """Path of the highest step per run among `(run_id, step, path, compatible)`."""
    newest = F.max(F.struct("step", "path"))
    return checkpoints.filter("compatible").groupBy("run_id").agg(newest.alias("_n")).select("run_id", "_n.step", "_n.path")


def newest_file(listing: DataFrame) -> DataFrame:
    newest = F.max(F.struct("modificationTime", "path"))["path"]
    return listing.groupBy("run_id").agg(newest.alias("path"))


def next_versions(listing: DataFrame) -> DataFrame:
    """Per model over `(model, path)`: highest version (NULL when none) and the next one."""
    top = F.max(version_of_file(F.col("path")))
    return listing.groupBy("model").agg(top.alias("highest"), (F.coalesce(top, F.lit(0)) + 1).alias("next_version"))


def normalised_metadata(checkpoints: DataFrame) -> DataFrame:
    """Flat metadata: the nested record first, then the outer fields, then a default."""
    m = "metadata."
    return checkpoints.select(
        "checkpoint_id",
        F.coalesce(m + "step", "step", F.lit(0)).cast("bigint").alias("step"),
        F.coalesce(m + "epoch", "epoch", F.lit(0.0)).cast("double").alias("epoch"),
        F.coalesce(m + "train_loss", F.lit(0.0)).cast("double").alias("train_loss"),
        F.col(m + "val_loss").cast("double").alias("val_loss"),
        F.coalesce(m + "learning_rate", "learning_rate", F.lit(0.0)).cast("double").alias("learning_rate"),
        F.coalesce(m + "timestamp", F.lit("")).alias("timestamp"),
        F.coalesce(m + "dataset_hash", F.lit("")).alias("dataset_hash"),
        F.coalesce(m + "is_best", F.lit(False)).alias("is_best"),
    )


def snapshot_diff(current: DataFrame, stored: DataFrame, key: str, value: str) -> DataFrame:
    """`(key, kind)` for each key that is missing from, unexpected in, or different in `stored`."""
    a = current.select(F.col(key).alias("_ka"), F.col(value).alias("_va"))
    b = stored.select(F.col(key).alias("_kb"), F.col(value).alias("_vb"))
    kind = (
        F.when(F.col("_kb").isNull(), "missing").when(F.col("_ka").isNull(), "unexpected")
        .when(~F.col("_va").eqNullSafe(F.col("_vb")), "mismatch")
    )
    both = a.join(b, F.col("_ka") == F.col("_kb"), "full").select(F.coalesce("_ka", "_kb").alias(key), kind.alias("kind"))
    return both.filter(F.col("kind").isNotNull())


def diff_report(diff: DataFrame, key: str, samples: int = 3) -> DataFrame:
    """One row: counts per kind, the smallest sample keys, and the verdict.

    The differences are computed once; ranking keeps `samples` rows per task and kind.
    """
    diff = cut_lineage(diff)
    kinds = ("missing", "unexpected", "mismatch")
    parts = diff.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("_key", F.lit(None).cast(diff.schema[key].dataType))
    rank = F.row_number().over(W.partitionBy("kind").orderBy(key))
    first = diff.withColumn("_rank", rank).filter(F.col("_rank") <= samples)
    parts = parts.unionByName(first.select("kind", F.lit(0).cast("bigint").alias("n"), F.col(key).alias("_key")))

    def of(k: str, value):
        return F.when(F.col("kind") == k, value)

    def sample(k: str):
        keys = F.array_sort(F.collect_list(of(k, F.col("_key"))))
        return F.array_join(F.transform(keys, lambda x: x.cast("string")), ",")

    out = parts.agg(
        *[F.coalesce(F.sum(of(k, F.col("n"))), F.lit(0)).alias(k) for k in kinds], *[sample(k).alias(k + "_sample") for k in kinds]
    )
    return out.withColumn("compatible", (F.col("missing") + F.col("unexpected") + F.col("mismatch")) == 0)


# Checkpoint key -> configuration key compared on resume.
CONFIG_ALIASES = [
    ("d_model", "d_model"), ("num_heads", "num_heads"), ("n_heads", "num_heads"), ("num_layers", "num_layers"),
    ("n_layers", "num_layers"), ("vocab_size", "vocab_size"), ("max_seq_length", "max_seq_length"),
    ("max_seq_len", "max_seq_length"),
]


def config_mismatches(checkpoints: DataFrame, configs: DataFrame, key: str = "run_id") -> DataFrame:
    """`(run_id, name, stored, wanted)` where both sides set an aliased key to different values.

    Both inputs are long tables `(run_id, name, value)`.
    """
    alias = F.create_map(*[F.lit(x) for old, new in {o: n for o, n in CONFIG_ALIASES}.items() for x in (old, new)])
    stored = checkpoints.withColumn("name", F.try_element_at(alias, F.col("name"))).filter(F.col("name").isNotNull())
    wanted = configs.select(key, "name", F.col("value").alias("wanted"))
    return (
        stored.withColumnRenamed("value", "stored").join(wanted, [key, "name"])
        .filter(F.col("stored") != F.col("wanted")).select(key, "name", "stored", "wanted")
    )


# ---------------------------------------------------------------- checks


def rule_checks(configs: DataFrame) -> DataFrame:
    """`(run_id, check_name, passed, level)`: one row per rule and run configuration."""
    heads, kv, d = F.col("num_heads"), F.col("kv_heads"), F.col("d_model")
    within = lambda c: (F.col(c) >= 0.0) & (F.col(c) <= 1.0)
    keys = [F.col(c).isNotNull() for c in ("vocab_size", "d_model", "num_heads", "num_layers")]
    rules = {
        "sections": (F.col("has_model") & F.col("has_training") & F.col("has_hardware"), "CRITICAL"),
        "model_keys": (functools.reduce(operator.and_, keys), "CRITICAL"),
        "architecture": (F.col("architecture").isin("base", "enhanced", "professional"), "ERROR"),
        "head_dimensions": (F.try_mod(d, heads) == 0, "ERROR"),
        "feed_forward": (F.col("d_ff") >= d, "ERROR"),
        "kv_groups": (~F.col("grouped_query") | (F.try_mod(heads, kv) == 0), "ERROR"),
        "kv_heads": (~F.col("grouped_query") | (kv <= heads), "ERROR"),
        "dropout": (within("dropout"), "WARNING"),
        "attention_dropout": (within("attention_dropout"), "WARNING"),
        "residual_dropout": (within("residual_dropout"), "WARNING"),
    }
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("passed"),
            F.when(F.coalesce(ok, F.lit(False)), F.lit("INFO")).otherwise(F.lit(level)).alias("level"),
        ) for name, (ok, level) in rules.items()
    ])
    return configs.select("run_id", F.inline(rows))


def check_rollup(checks: DataFrame) -> DataFrame:
    """Per run; warnings count the WARNING level whether or not the check passed."""
    failed = ~F.col("passed")
    return checks.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(failed).alias("failed"),
        F.count_if(F.col("level") == "WARNING").alias("warnings"),
        (~F.bool_or(failed & F.col("level").isin("ERROR", "CRITICAL"))).alias("can_proceed"),
    )


# ---------------------------------------------------------------- corpora and their outputs


def reusable_outputs(requests: DataFrame, manifest: DataFrame, meta: DataFrame, vocab_sizes: DataFrame) -> DataFrame:
    """Add `reusable` to requests `(corpus, fingerprint, max_seq_length, vocab_size)`.

    True when the corpus has a finished output with the same fingerprint and length, and its
    stored vocabulary has the recorded and at least the requested size.
    """
    stored = (
        manifest.join(meta, "corpus").join(vocab_sizes, "corpus")
        .select(
            "corpus", F.col("fingerprint").alias("_f"), "files_exist", "completed", "tokenizer_trained", "data_tokenized",
            F.col("meta_length").alias("_l"), F.col("meta_vocab").alias("_v"), F.col("tokens").alias("_t"),
        )
    )
    ok = (
        F.col("files_exist") & F.col("completed") & F.col("tokenizer_trained") & F.col("data_tokenized")
        & (F.col("_f") == F.col("fingerprint")) & (F.col("_l") == F.col("max_seq_length"))
        & (F.col("_v") == F.col("_t")) & (F.col("_t") >= F.col("vocab_size"))
    )
    return requests.join(stored, "corpus", "left").select(*requests.columns, F.coalesce(ok, F.lit(False)).alias("reusable"))


def stale_requests(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requests without an output that carries their current fingerprint."""
    return requests.join(manifest.select("corpus", "fingerprint").distinct(), ["corpus", "fingerprint"], "left_anti")


# Path, type, default and name of each run parameter taken from a nested record.
RUN_PARAMETERS = [
    ("model_architecture.dimensions.vocabulary_size", "int", 50000, "vocab_size"),
    ("model_architecture.dimensions.embedding_dimension", "int", 768, "d_model"),
    ("model_architecture.dimensions.attention_head_count", "int", 12, "num_heads"),
    ("model_architecture.dimensions.transformer_layer_count", "int", 16, "num_layers"),
    ("model_architecture.dimensions.feed_forward_dimension", "int", 3072, "d_ff"),
    ("model_architecture.dimensions.maximum_sequence_length", "int", 1024, "max_seq_length"),
    ("model_architecture.regularization.dropout_probability", "double", 0.1, "dropout"),
    ("training_configuration.optimizer.learning_rate", "double", 3e-4, "learning_rate"),
    ("training_configuration.optimizer.weight_decay_coefficient", "double", 0.1, "weight_decay"),
    ("training_configuration.learning_rate_schedule.warmup_steps_count", "int", 1000, "warmup_steps"),
    ("training_configuration.duration.total_training_steps", "int", 10000, "max_steps"),
    ("training_configuration.batch_configuration.batch_size_per_device", "int", 8, "batch_size"),
    ("training_configuration.monitoring.evaluation_interval_steps", "int", 500, "eval_interval"),
    ("training_configuration.checkpoint_management.keep_last_n_checkpoints", "int", 3, "keep_last_n"),
    ("dataset_configuration.training_dataset.name", "string", "roneneldan/TinyStories", "dataset"),
    ("dataset_configuration.split_ratios.train", "double", 0.9, "train_ratio"),
    ("dataset_configuration.split_ratios.validation", "double", 0.05, "validation_ratio"),
    ("dataset_configuration.split_ratios.test", "double", 0.05, "test_ratio"),
    ("infrastructure_configuration.modal_gpu.gpu_type", "string", "A10G", "gpu_type"),
    ("budget_configuration.monthly_budget_usd", "double", 30.0, "monthly_budget"),
    ("budget_configuration.safety_margin_percentage", "double", 90.0, "safety_margin_pct"),
]
PHASE_TYPE = "struct<dataset:string,training_steps:bigint,gpu_type:string,estimated_cost_usd:double,description:string>"
# Phase key -> (name, phase, required checkpoint, checkpoint written).
PHASE_NAMES = {
    "phase_1_foundation": ("Foundation", "foundation", None, "foundation_checkpoint.pt"),
    "phase_2_expansion": ("Expansion", "expansion", "foundation_checkpoint.pt", "expanded_checkpoint.pt"),
    "phase_3_specialization": ("Specialization", "specialization", "expanded_checkpoint.pt", "production_checkpoint.pt"),
}


def run_config_schema() -> T.StructType:
    """Schema of the nested run record, built from the parameter list."""
    tree: dict = {}
    for path, kind, _, _ in RUN_PARAMETERS:
        *outer, leaf = path.split(".")
        node = tree
        for name in outer:
            node = node.setdefault(name, {})
        node[leaf] = kind

    def text(node) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"{k}:{text(v)}" for k, v in node.items()) + ">"

    tree["budget_configuration"]["training_phases"] = f"map<string,{PHASE_TYPE}>"
    return T.StructType.fromDDL(text(tree)[len("struct<"):-1])


def flat_run_config(records: DataFrame, key: str = "run_id") -> DataFrame:
    """One row of run parameters per nested record; missing values take their default."""
    return records.select(
        key, *[F.coalesce(F.col(path), F.lit(default)).cast(kind).alias(name) for path, kind, default, name in RUN_PARAMETERS]
    )


def config_phases(records: DataFrame, key: str = "run_id") -> DataFrame:
    """One row per planned phase of each record, in the order of the phase keys."""
    flat = flat_run_config(records, key).select(
        key, F.col("dataset").alias("_ds"), F.col("max_steps").alias("_steps"), F.col("gpu_type").alias("_gpu")
    )
    rows = records.select(key, F.explode("budget_configuration.training_phases").alias("phase_key", "p")).join(flat, key)
    known = F.create_map(*[
        x for k, v in PHASE_NAMES.items() for x in (F.lit(k), F.struct(
            *[F.lit(a).cast("string").alias(n) for a, n in zip(v, ("name", "phase", "requires_checkpoint", "checkpoint_name"))]
        ))
    ])
    other = F.struct(
        F.initcap(F.replace(F.col("phase_key"), F.lit("_"), F.lit(" "))).alias("name"), F.col("phase_key").alias("phase"),
        F.lit(None).cast("string").alias("requires_checkpoint"), F.concat("phase_key", F.lit(".pt")).alias("checkpoint_name"),
    )
    return rows.withColumn("_k", F.coalesce(F.try_element_at(known, F.col("phase_key")), other)).select(
        key, "phase_key", "_k.name", "_k.phase",
        F.coalesce("p.dataset", "_ds").alias("dataset"),
        F.coalesce("p.training_steps", F.col("_steps").cast("bigint")).alias("max_steps"),
        F.coalesce("p.gpu_type", "_gpu").alias("gpu_type"),
        F.coalesce("p.estimated_cost_usd", F.lit(0.0)).alias("estimated_cost"),
        F.coalesce("p.description", F.lit("")).alias("description"),
        "_k.checkpoint_name", "_k.requires_checkpoint",
    )


# ---------------------------------------------------------------- sets


def appended(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """Both tables by column name; a field that one side lacks is NULL there."""
    return ledger.unionByName(records, allowMissingColumns=True)


def key_difference(left: DataFrame, right: DataFrame, key: str, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Keys that only one of two key sets has, and which one; repeated keys stay, and a NULL key equals none.

    Both sides are counted in one hash aggregate, so each is read once and nothing is sorted.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = left.select(key, one.alias("_l"), none.alias("_r")).unionByName(right.select(key, none.alias("_l"), one.alias("_r")))
    counts = both.groupBy(key).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    alone = F.col(key).isNull()
    sides = F.concat(
        F.when(alone | (F.col("_r") == 0), F.array_repeat(F.lit(left_name), F.col("_l").cast("int"))).otherwise(F.array()),
        F.when(alone | (F.col("_l") == 0), F.array_repeat(F.lit(right_name), F.col("_r").cast("int"))).otherwise(F.array()),
    )
    return counts.select(key, F.explode(sides).alias("side"))
