"""Metric, cost and schedule formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GPU tiers in recommendation order.
# (gpu, gpu_order, cost_per_hour, steps_per_minute, memory_gb, recommended_batch_size)
GPU_SPECS = [
    ("T4", 1, 0.50, 100, 16, 16),
    ("A10G", 2, 1.10, 250, 24, 32),
    ("A100-40GB", 3, 3.00, 500, 40, 64),
    ("A100-80GB", 4, 4.00, 600, 80, 128),
    ("H100", 5, 5.00, 800, 80, 128),
]
DEFAULT_GPU = "A10G"
SAFETY_MARGIN = 0.90
OVERHEAD = 1.10


def gpu_specs_array() -> Column:
    """The tiers as a literal array, so a sweep is an explode and not a join."""
    return F.array(*[
        F.struct(
            F.lit(g).alias("gpu"), F.lit(o).alias("gpu_order"), F.lit(c).alias("cost_per_hour"),
            F.lit(s).alias("steps_per_minute"), F.lit(m).alias("memory_gb"),
            F.lit(b).alias("recommended_batch_size"),
        )
        for g, o, c, s, m, b in GPU_SPECS
    ])


def gpu_of_order(order: Column) -> Column:
    """The name of the tier with that place in the fixed order."""
    return F.get(F.filter(gpu_specs_array(), lambda s: s["gpu_order"] == order), F.lit(0))["gpu"]


def gpu_spec(gpu: Column) -> Column:
    """The tier's struct; an unknown name gets the default tier."""
    known = F.filter(gpu_specs_array(), lambda s: s["gpu"] == gpu)
    default = F.filter(gpu_specs_array(), lambda s: s["gpu"] == DEFAULT_GPU)
    return F.coalesce(F.get(known, F.lit(0)), F.get(default, F.lit(0)))


def perplexity(loss: Column, cap: float) -> Column:
    return F.exp(F.least(loss, F.lit(float(cap))))


def improvement_pct(initial: Column, final: Column) -> Column:
    return F.when(initial > 0, (1 - final / initial) * 100).otherwise(F.lit(0.0))


def expected_lr(step: Column, base: float, warmup: int, max_steps: int, min_lr: float = 1e-5) -> Column:
    """Linear warm-up, then cosine decay to `min_lr`; NULL when the decay has no length."""
    # Fixed value: the schedule uses pi = 3.14159.
    part = F.try_divide((step - warmup).cast("double"), F.lit(float(max_steps - warmup)))
    decay = min_lr + (base - min_lr) * 0.5 * (1 + F.cos(F.least(part, F.lit(1.0)) * 3.14159))
    return F.when(step < warmup, base * step / F.lit(warmup)).when(part.isNotNull(), decay)


def _million(x: Column) -> Column:
    return x.cast("double") / F.lit(1e6)


def params_millions(v: Column, d: Column, layers: Column, f: Column) -> Column:
    """Size that drives the cost estimate: at least 1.0, one decimal."""
    v, d, layers, f = (c.cast("bigint") for c in (v, d, layers, f))
    return F.greatest(F.lit(1.0), F.round(_million(v * d + 4 * layers * d * d + 3 * layers * d * f), 1))


def params_attention_only(v: Column, d: Column, layers: Column) -> Column:
    v, d, layers = (c.cast("bigint") for c in (v, d, layers))
    return v * d + 12 * layers * d * d


def params_tied_twice(v: Column, d: Column, layers: Column, f: Column) -> Column:
    v, d, layers, f = (c.cast("bigint") for c in (v, d, layers, f))
    return 2 * v * d + 4 * layers * d * d + 2 * layers * d * f


def memory_gb(v: Column, d: Column, layers: Column, batch: Column, seq: Column) -> Column:
    gib = F.lit(float(1024**3))
    weights = params_attention_only(v, d, layers).cast("double") * 4 / gib
    activations = (
        batch.cast("double") * seq.cast("double") * d.cast("double") * layers.cast("double") * 4 / gib
    )
    return (weights * 3 + activations) * 1.2


def training_mb(params: Column) -> Column:
    """Rough GPU need in MB: weights, gradients, optimizer and activations of float32 parameters."""
    return params.cast("double") * 4 / float(1024**2) * 4


def fitting_batch(v: Column, d: Column, layers: Column, f: Column, seq: Column, gpu_gb: Column) -> Column:
    """Largest power of two <= 256 that fits; NULL when weights alone do not fit."""
    gib = F.lit(float(1024**3))
    model = params_tied_twice(v, d, layers, f).cast("double") * 4 / gib
    sample = layers.cast("double") * seq.cast("double") * d.cast("double") * 16 / gib
    free = gpu_gb.cast("double") * 0.8 - model * 3
    fits = F.greatest(F.lit(1.0), F.least(F.lit(256.0), F.floor(free / sample).cast("double")))
    return F.when(free > 0, F.pow(F.lit(2.0), F.floor(F.log2(fits))).cast("int"))


def estimated_hours(steps: Column, params_m: Column, steps_per_minute: Column) -> Column:
    factor = F.greatest(F.lit(0.5), F.least(F.lit(2.0), F.lit(200.0) / params_m))
    return steps / (steps_per_minute * factor * 60) * OVERHEAD


def budget_columns(cost: Column, spent: Column, budget: Column) -> dict[str, Column]:
    """Fit flags, utilisation and warning text for a planned cost."""
    safe_left = budget * SAFETY_MARGIN - spent
    use = (spent + cost) / budget * 100
    within_safety = cost <= safe_left
    # The two warning texts.
    warning = (
        F.when(
            ~within_safety,
            F.format_string(
                "Cost $%.2f exceeds safety margin. Only $%.2f available (90%% of budget).", cost, safe_left
            ),
        ).when(use > 80, F.format_string("Warning: This will use %.1f%% of monthly budget.", use))
    )
    return {
        "within_budget": cost <= budget - spent,
        "within_safety": within_safety,
        "utilization_pct": use,
        "warning": warning,
    }


def duration_hours(started: Column, ended: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", started, ended) / F.lit(3.6e9)


def fingerprint(*parts: Column) -> Column:
    """First 16 hex digits of SHA-256 over the parts joined by `_`."""
    return F.substring(F.sha2(F.concat_ws("_", *parts), 256), 1, 16)


def ratios_text(train: Column, validation: Column, test: Column) -> Column:
    """Split ratios in the text form that enters the fingerprint."""
    return F.concat(
        F.lit("{'train': "), train.cast("string"), F.lit(", 'validation': "), validation.cast("string"),
        F.lit(", 'test': "), test.cast("string"), F.lit("}"),
    )
