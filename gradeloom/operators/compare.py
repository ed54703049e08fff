"""Comparisons between models and between frameworks, over summary tables.

Inputs are already aggregated to a few rows per model or framework.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Metrics of the comparison matrix; fallbacks of the chart data.
COMPARED = ("bleu_4", "rouge_l", "bertscore_f1")
MISSING_LATENCY, MISSING_MEMORY, FLAT_SCORE = 1.0, 2.0, 0.5


def side_by_side(references: DataFrame, predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """Each sample with one answer column per model, null where a model gave none."""
    answers = predictions.groupBy("id").agg(
        *[F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(f"generated_{m}") for m in models]
    )
    return references.join(answers, "id", "left")


def unpivot(wide: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """(key, metric, value) rows from one column per metric."""
    doubles = wide.select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    return doubles.unpivot([key], list(metrics), "metric", "value")


def comparison_matrix(wide: DataFrame, models: Sequence[str], metrics: Sequence[str] = COMPARED) -> DataFrame:
    """One row per metric, one column per model."""
    return unpivot(wide, "model", metrics).groupBy("metric").agg(
        *[F.max(F.when(F.col("model") == m, F.col("value"))).alias(m) for m in models]
    )


def best_per_metric(
    long: DataFrame, key: str = "model", lower_is_better: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """The winner of each metric; ties go to the earliest in ``order``, then by name."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(key)) if order else F.lit(0)
    place = F.when(place == 0, len(order) + 1).otherwise(place)
    signed = F.when(F.col("metric").isin(*lower_is_better), -F.col("value")).otherwise(F.col("value")) \
        if lower_is_better else F.col("value")
    candidates = long.where("value IS NOT NULL")
    best = F.min(F.struct((-signed).alias("s"), place.alias("p"), F.col(key).alias("k"), F.col("value").alias("v")))
    return candidates.groupBy("metric").agg(best.alias("b")).select(
        "metric", F.col("b.k").alias(key), F.col("b.v").alias("value")
    )


def against_baseline(long: DataFrame, baseline: str, key: str = "model") -> DataFrame:
    """Every row beside the baseline's value of the same metric; one reading of the (aggregated) table.

    Metrics that the baseline does not have are left out.
    """
    same = Window.partitionBy("metric")
    is_base = F.col(key) == baseline
    return (
        long.withColumn("baseline", F.max(F.when(is_base, F.col("value"))).over(same))
        .withColumn("_covered", F.count_if(is_base).over(same) > 0)
        .where("_covered")
        .drop("_covered")
    )


def speedup(summary: DataFrame, baseline: str, column: str = "avg_throughput") -> DataFrame:
    """Throughput relative to the baseline framework."""
    pairs = against_baseline(unpivot(summary, "framework", [column]), baseline, "framework")
    return pairs.select(
        "framework",
        F.col("value").alias("throughput"),
        F.when(F.col("baseline") > 0, F.col("value") / F.col("baseline")).alias("speedup"),
    )


def before_after(wide: DataFrame, baseline: str, metrics: Sequence[str]) -> DataFrame:
    """Change against the base model; the percentage is given only for improvements."""
    pairs = against_baseline(unpivot(wide, "model", metrics), baseline)
    change = F.col("value") - F.col("baseline")
    return pairs.where(F.col("model") != baseline).select(
        "model", "metric", "baseline", "value", change.alias("delta"),
        F.when((change > 0) & (F.col("baseline") != 0), change / F.col("baseline") * 100).alias("improvement_percent"),
    )


def _min_max(value: Column, invert: bool) -> Column:
    """Scale to 0..1 over all rows of the (aggregated) table; all equal gives the flat score."""
    everything = Window.partitionBy()
    low, high = F.min(value).over(everything), F.max(value).over(everything)
    gain = (high - value) if invert else (value - low)
    return F.when(high == low, FLAT_SCORE).otherwise(gain / (high - low))


def radar_scores(summary: DataFrame, setup_ease: dict[str, float]) -> DataFrame:
    """Speed, throughput, memory and set-up scores between 0 and 1, higher is better."""
    memory = F.col("peak_memory_gb")
    memory = F.when(memory > 0, memory).otherwise(MISSING_MEMORY)
    ease = F.coalesce(*[F.when(F.col("framework") == k, F.lit(float(v))) for k, v in setup_ease.items()], F.lit(None))
    return summary.select(
        "framework",
        _min_max(F.coalesce("avg_latency_s", F.lit(MISSING_LATENCY)), True).alias("speed"),
        _min_max(F.coalesce("avg_throughput", F.lit(0.0)), False).alias("throughput"),
        _min_max(memory, True).alias("memory_efficiency"),
        ease.alias("setup_ease"),
    )


def summary_table(parts: Sequence[tuple[DataFrame, Sequence[str]]], frameworks: Sequence[str]) -> DataFrame:
    """Metric rows by framework columns from several per-framework summaries.

    A framework that a summary does not cover shows null.
    """
    long = None
    for wide, metrics in parts:
        rows = unpivot(wide, "framework", metrics)
        long = rows if long is None else long.unionByName(rows)
    return long.groupBy("metric").agg(
        *[F.max(F.when(F.col("framework") == f, F.col("value"))).alias(f) for f in frameworks]
    )


def upsert_metrics(current: DataFrame, update: DataFrame, key: Sequence[str]) -> DataFrame:
    """Update metric columns where new values exist, keep the old ones, add new rows."""
    columns = [c for c in dict.fromkeys(current.columns + update.columns) if c not in key]
    old = current.withColumnsRenamed({c: f"_old_{c}" for c in current.columns if c not in key})
    joined = old.join(update, list(key), "full")
    sources = {
        c: [F.col(n) for n, present in ((c, c in update.columns), (f"_old_{c}", c in current.columns)) if present]
        for c in columns
    }
    return joined.select(*key, *[F.coalesce(*cs).alias(c) for c, cs in sources.items()])


def with_labels(df: DataFrame, labels: dict[str, str], key: str = "framework") -> DataFrame:
    """Display label of an internal key; unknown keys label themselves."""
    known = F.coalesce(*[F.when(F.col(key) == k, F.lit(v)) for k, v in labels.items()], F.col(key))
    return df.withColumn("label", known)
