"""Benchmark-log analytics over rows of single generation requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.percentiles import with_percentiles
from gradeloom.session import join_groups, small_side

# Request timeout, warm-up length, z-value of the 90th percentile.
TIMEOUT_S = 60.0
WARMUP = 3
P90_Z = 1.28
BY = ("framework",)


#: Types from the narrowest to the one that takes all others.
WIDENING = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string")


def agreed_type(types: Sequence[str]) -> str:
    """The type that several logs' columns of one name are read as.

    Equal types stay; numbers take the widest; whatever else differs becomes text.
    """
    found = set(types) - {"void"}
    if len(found) < 2:
        return next(iter(found), "string")
    if any(t not in WIDENING for t in found) or "boolean" in found:
        return "string"
    return "double" if "float" in found and found & {"int", "bigint"} else max(found, key=WIDENING.index)


def append_logs(*logs: DataFrame) -> DataFrame:
    """Logs of different versions one after the other: missing columns are null, types are agreed on by name."""
    if not logs:
        raise ValueError("no logs are given")
    types: dict[str, list[str]] = {}
    for log in logs:
        for name, kind in log.dtypes:
            types.setdefault(name, []).append(kind)
    wide = {name: agreed_type(kinds) for name, kinds in types.items()}
    made = [log.select(*[F.col(f"`{c}`").cast(wide[c]).alias(c) for c in log.columns]) for log in logs]
    out = made[0]
    for log in made[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in wide.items()])


def throughput() -> Column:
    """Tokens per second of one request, 0 when it took no time."""
    return F.when(F.col("latency_s") > 0, F.col("tokens_generated") / F.col("latency_s")).otherwise(0.0)


def drop_warmup(requests: DataFrame, warmup: int = WARMUP, by: Sequence[str] = BY) -> DataFrame:
    """Leave out each group's first ``warmup`` requests in (ts, request_id) order.

    Only the first rows of a group are ranked, and each task passes on at most
    ``warmup`` of them; the measured requests are then those after the last one.
    """
    if warmup <= 0:
        return requests
    first = Window.partitionBy(*by).orderBy("ts", "request_id")
    cutoff = (
        requests.select(*by, "ts", "request_id")
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= warmup)
        .groupBy(*by)
        .agg(F.max(F.struct("ts", "request_id")).alias("_cutoff"))
    )
    return (
        join_groups(requests, small_side(cutoff), by)
        .where(F.struct("ts", "request_id") > F.col("_cutoff"))
        .drop("_cutoff")
    )


def benchmark_summary(requests: DataFrame, by: Sequence[str] = BY, exact: bool = True) -> DataFrame:
    """Latency mean, range and percentiles, throughput, tokens and memory per group.

    ``exact=False`` takes percentiles from a sketch in the same pass.
    """
    named = {"p50_latency_s": 0.5, "p90_latency_s": 0.9, "p99_latency_s": 0.99}
    rate = throughput()
    aggregates = [
        F.avg("latency_s").alias("avg_latency_s"),
        F.min("latency_s").alias("min_latency_s"),
        F.max("latency_s").alias("max_latency_s"),
        F.avg(rate).alias("avg_throughput"),
        F.sum("tokens_generated").cast("long").alias("total_tokens"),
        F.coalesce(F.max("memory_used_gb"), F.lit(0)).cast("double").alias("peak_memory_gb"),
        F.coalesce(F.avg("memory_used_gb"), F.lit(0.0)).alias("avg_memory_gb"),
        F.count(F.lit(1)).alias("num_requests"),
    ]
    if not exact:
        aggregates += [F.percentile_approx("latency_s", p, 10_000).alias(name) for name, p in named.items()]
    summary = requests.groupBy(*by).agg(*aggregates)
    return with_percentiles(summary, requests, by, "latency_s", named) if exact else summary


def engine_summary(requests: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The engine's own short summary: requests, two means, peak memory and token total."""
    return requests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_requests"),
        F.avg("latency_s").alias("avg_latency_s"),
        F.avg(throughput()).alias("avg_throughput"),
        F.coalesce(F.max("memory_used_gb"), F.lit(0)).cast("double").alias("peak_memory_gb"),
        F.sum("tokens_generated").cast("long").alias("total_tokens"),
        F.sum("latency_s").alias("total_time_s"),
    )


def _spread_of(c: Column) -> Column:
    """Sample standard deviation, 0 for a single value, null for none."""
    return F.when(F.count(c) > 1, F.stddev_samp(c)).when(F.count(c) == 1, 0.0)


def mean_std_summary(requests: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    rate = throughput()
    return requests.groupBy(*by).agg(
        F.avg("latency_s").alias("avg_latency_s"),
        _spread_of(F.col("latency_s")).alias("std_latency_s"),
        F.avg("tokens_generated").alias("avg_tokens_generated"),
        F.avg(rate).alias("avg_throughput"),
        _spread_of(rate).alias("std_throughput"),
        F.coalesce(F.max("memory_used_gb"), F.lit(0)).cast("double").alias("peak_memory_gb"),
    )


def mask_timeouts(requests: DataFrame, timeout: float = TIMEOUT_S) -> DataFrame:
    """Requests as the logging client records them: a timeout has no tokens and no throughput."""
    return requests.withColumn(
        "tokens_generated", F.when(F.col("latency_s") >= timeout, 0).otherwise(F.col("tokens_generated"))
    )


def timeout_summary(requests: DataFrame, by: Sequence[str] = BY, timeout: float = TIMEOUT_S) -> DataFrame:
    """Mean and deviation without timeouts; three independent filters in one pass.

    Groups in which every request timed out give no row.
    """
    rate = throughput()
    latency = F.when(F.col("latency_s") < timeout, F.col("latency_s"))
    tokens = F.when(F.col("tokens_generated") > 0, F.col("tokens_generated"))
    speed = F.when(rate > 0, rate)

    return (
        requests.groupBy(*by)
        .agg(
            F.avg(latency).alias("avg_latency_s"),
            F.coalesce(_spread_of(latency), F.lit(0.0)).alias("std_latency_s"),
            F.coalesce(F.avg(tokens), F.lit(0.0)).alias("avg_tokens_generated"),
            F.coalesce(F.avg(speed), F.lit(0.0)).alias("avg_throughput"),
            F.coalesce(_spread_of(speed), F.lit(0.0)).alias("std_throughput"),
            F.count_if(F.col("latency_s") >= timeout).alias("timeouts"),
            F.count(latency).alias("answered"),
        )
        .where(F.col("answered") > 0)
    )


def std_from_p90(summary: DataFrame) -> DataFrame:
    """Deviation estimated from the 90th percentile, and mean tokens per request."""
    return summary.withColumns(
        {
            "std_from_p90": (F.col("p90_latency_s") - F.col("avg_latency_s")) / P90_Z,
            "avg_tokens_generated": F.col("total_tokens") / F.col("num_requests"),
        }
    )


def display_table(summary: DataFrame) -> DataFrame:
    """The comparison columns at their display precision, as numbers."""
    return summary.select(
        "framework",
        F.round("avg_latency_s", 3).alias("avg_latency_s"),
        F.round("p90_latency_s", 3).alias("p90_latency_s"),
        F.round("avg_throughput", 1).alias("avg_throughput"),
        F.round("peak_memory_gb", 2).alias("peak_memory_gb"),
        "total_tokens",
    )


def step_status(df: DataFrame, failed: Column, error: Column, by: Sequence[str] = BY) -> DataFrame:
    """One status row per group: ``ok`` or ``error`` with the first message in order."""
    message = F.min(F.when(failed, error))
    return df.groupBy(*by).agg(
        F.when(F.count_if(failed) == 0, "ok").otherwise("error").alias("status"),
        message.alias("error"),
        F.count_if(failed).alias("failed"),
    )
