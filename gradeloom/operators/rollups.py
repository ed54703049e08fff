"""Stored request summaries per hour, merged to any range without reading the log again.

A row holds what can be added up, and a quantile sketch of the latencies. Ranges, days and
late arrivals are merges of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.requests import BY, throughput
from gradeloom.session import join_groups
from gradeloom.sources import versions

#: Size of a sketch: a few thousand numbers a row, exact below it.
SKETCH_K = 1600
#: A quantile's rank is off by at most this share of the rows: twice the bound that the
#: sketch's authors give for 99 of 100 cases at this size.
RANK_ERROR = 2 * 2.296 / SKETCH_K**0.9723
QUANTILES = {"p50_latency_s": 0.5, "p90_latency_s": 0.9, "p99_latency_s": 0.99}

_SUMS = ("num_requests", "latency_sum", "rate_sum", "total_tokens", "memory_sum", "memory_n")


def hourly(requests: DataFrame, by: Sequence[str] = BY, unit: str = "hour") -> DataFrame:
    """One row per ``unit`` of time and group of a request log; one pass, merged on the map side."""
    return requests.groupBy(F.date_trunc(unit, "ts").alias("hour"), *by).agg(
        F.count(F.lit(1)).alias("num_requests"),
        F.sum("latency_s").alias("latency_sum"),
        F.sum(throughput()).alias("rate_sum"),
        F.sum("tokens_generated").cast("long").alias("total_tokens"),
        F.sum("memory_used_gb").cast("double").alias("memory_sum"),
        F.count("memory_used_gb").alias("memory_n"),
        F.min("latency_s").alias("min_latency_s"),
        F.max("latency_s").alias("max_latency_s"),
        F.max("memory_used_gb").cast("double").alias("peak_memory_gb"),
        F.kll_sketch_agg_double(F.col("latency_s").cast("double"), F.lit(SKETCH_K)).alias("latencies"),
    )


def merged(rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key merged: counts added, ends compared, sketches joined."""
    return rollup.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("min_latency_s").alias("min_latency_s"),
        F.max("max_latency_s").alias("max_latency_s"),
        F.max("peak_memory_gb").alias("peak_memory_gb"),
        F.kll_merge_agg_double("latencies", F.lit(SKETCH_K)).alias("latencies"),
    )


def add_requests(requests: DataFrame, root: str, by: Sequence[str] = BY) -> int:
    """Publish the rollup below ``root`` with more requests in it, late ones of known hours too."""
    new = hourly(requests, by)
    return versions.change(
        requests.sparkSession, root, lambda old: new if old is None else merged(old.unionByName(new), ["hour", *by])
    )


def summary(rollup: DataFrame, by: Sequence[str] = BY, begin: str | None = None, end: str | None = None) -> DataFrame:
    """The benchmark summary of the hours from ``begin`` up to ``end``; quantiles within ``RANK_ERROR``."""
    if begin is not None:
        rollup = rollup.where(F.col("hour") >= F.lit(begin).cast("timestamp"))
    if end is not None:
        rollup = rollup.where(F.col("hour") < F.lit(end).cast("timestamp"))
    found = merged(rollup, by)
    return found.select(
        *by, "num_requests", (F.col("latency_sum") / F.col("num_requests")).alias("avg_latency_s"), "min_latency_s", "max_latency_s",
        *[F.kll_sketch_get_quantile_double("latencies", F.lit(p)).alias(name) for name, p in QUANTILES.items()],
        (F.col("rate_sum") / F.col("num_requests")).alias("avg_throughput"), "total_tokens",
        F.coalesce("peak_memory_gb", F.lit(0.0)).alias("peak_memory_gb"),
        F.coalesce(F.col("memory_sum") / F.when(F.col("memory_n") > 0, F.col("memory_n")), F.lit(0.0)).alias("avg_memory_gb"),
    )


def rank_errors(found: DataFrame, requests: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """By how much the ranks of a summary's quantiles miss, as shares of the rows, counted in the log itself."""
    joined = join_groups(requests.select(*by, "latency_s"), found.select(*by, *QUANTILES), by)
    n = F.count(F.lit(1))

    def miss(name: str, p: float):
        below, upto = F.count_if(F.col("latency_s") < F.col(name)) / n, F.count_if(F.col("latency_s") <= F.col(name)) / n
        return F.greatest(below - p, p - upto, F.lit(0.0)).alias(name.replace("_latency_s", "_rank_error"))

    return joined.groupBy(*by).agg(*[miss(name, p) for name, p in QUANTILES.items()])
