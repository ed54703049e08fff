"""Dataset statistics and exploratory summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.text import has_text
from gradeloom.operators.percentiles import value_slot
from gradeloom.operators.prefix import running
from gradeloom.session import join_groups

LENGTHS = ("instruction_len", "context_len", "response_len")


def with_lengths(df: DataFrame) -> DataFrame:
    """Character lengths of the three text columns and the context flag."""
    return df.withColumns(
        {f"{c}_len": F.length(c) for c in ("instruction", "context", "response")}
        | {"has_context": has_text("context")}
    )


def dataset_stats(formatted: DataFrame) -> DataFrame:
    """Rows, categories and text length range per split; lengths are 0 where there is no text."""
    size = F.length("text")
    return formatted.groupBy("split").agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.count_distinct(F.coalesce("category", F.lit("unknown"))).alias("num_categories"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("avg_text_length"),
        F.coalesce(F.max(size), F.lit(0)).cast("long").alias("max_text_length"),
        F.coalesce(F.min(size), F.lit(0)).cast("long").alias("min_text_length"),
    )


def category_counts(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    category = F.coalesce("category", F.lit("unknown")).alias("category")
    return df.groupBy(*by, category).agg(F.count(F.lit(1)).alias("n"))


def category_map(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """The same counts as one map per group."""
    entries = F.array_sort(F.collect_list(F.struct("category", "n")))
    return category_counts(df, by).groupBy(*by).agg(F.map_from_entries(entries).alias("categories"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Counts of each value with its share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``metric, value, n``: how often a column holds a value. All summaries below follow from it.

    Rows are measured once; the map side merges equal values, so lengths shrink to a row
    per length before they are shuffled.
    """
    return _long(df, columns).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))


def _quantile(p: float) -> Column:
    """Interpolated between the values at the ranks around ``p``, over rows with ``_before`` and ``_upto``."""
    at = F.col("_rows") * p - p
    value = lambda rank: F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_upto")), F.col("value")))
    low, high = value(F.floor(at)), value(F.ceil(at))
    return F.when(low == high, low).otherwise(low + (high - low) * F.max(at - F.floor(at)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, quartiles and max, one row per column.

    All from one table of value counts, which is shuffled once; running counts are taken in
    chunks of near values, so no task holds all values of a column.
    """
    counts = value_counts(df, columns)
    rows = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    totals = counts.groupBy("metric").agg(
        rows.alias("_rows"),
        (F.sum(F.col("value") * F.col("n")) / F.when(rows > 0, rows)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # a filter of nulls would be pushed below the counts, which could then not be shared
    known = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    slotted = counts.withColumns({"_slot": value_slot(F.col("value")), "n": known})
    ranked = running(slotted, ["metric"], "_slot", ["value"], "n", "sum", "_upto")
    ranked = ranked.withColumn("_before", F.col("_upto") - F.col("n"))
    squares = F.sum((F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean")) * F.col("n"))
    return join_groups(totals, ranked.select("metric", "value", "n", "_before", "_upto"), ["metric"], "left").groupBy(
        "metric", F.col("_rows").alias("count"), "mean", "min", "max"
    ).agg(
        F.when(F.max("_rows") > 1, F.sqrt(squares / (F.max("_rows") - 1))).alias("std"),
        *[_quantile(p).alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))],
    ).select("metric", "count", "mean", "std", "min", "max", "p25", "p50", "p75")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max; the last bin includes the maximum.

    Range and bins both follow from the value counts. The range table has one row per
    requested column.
    """
    counts = value_counts(df, columns).where("value IS NOT NULL")
    # over the counts as they are: without ``n`` the planner would drop them and read the rows again
    held = F.when(F.col("n") > 0, F.col("value"))
    spans = counts.groupBy("metric").agg(F.min(held).alias("low"), F.max(held).alias("high"))
    # a column with a single value spans one unit around it, as plotting libraries do
    flat = F.col("high") == F.col("low")
    spans = spans.select(
        "metric",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")).alias("span"),
    )
    place = F.least(F.floor((F.col("value") - F.col("low")) / F.col("span") * bins), F.lit(bins - 1))
    return (
        counts.join(F.broadcast(spans), "metric")
        .groupBy("metric", place.cast("long").alias("bin"), "low", "span")
        .agg(F.sum("n").alias("n"))
        .select(
            "metric", "bin",
            (F.col("low") + F.col("bin") * F.col("span") / bins).alias("bin_start"),
            "n",
        )
    )


def over_length(df: DataFrame, size: str, limit: int = 2048) -> DataFrame:
    """How many rows are longer than ``limit``, as a count and a percentage."""
    over = F.count_if(F.col(size) > limit)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("num_samples"),
        over.alias("over_limit"),
        F.when(total > 0, over * 100.0 / total).alias("over_percent"),
    )
