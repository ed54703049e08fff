"""Human ratings: annotation sheets and score summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.schemas import CRITERIA


def annotation_sheet(samples: DataFrame) -> DataFrame:
    """Samples with every rating set to 0 and room for notes."""
    return samples.select(
        "id", "prompt", "reference", "generated",
        *[F.lit(0).alias(c) for c in CRITERIA],
        F.lit("").alias("notes"),
    )


def nested_annotation_sheet(samples: DataFrame, systems: tuple[str, ...]) -> DataFrame:
    """One row per sample with an answer and a zeroed rating struct per system."""
    zeros = F.struct(*[F.lit(0).alias(c) for c in CRITERIA])
    return samples.withColumns({f"eval_{s}": zeros for s in systems})


def ratings_long(rated: DataFrame, systems: tuple[str, ...], key: str = "id") -> DataFrame:
    """Nested per-system rating structs as (sample_id, system, criterion, score) rows."""
    entries = F.array(
        *[
            F.struct(F.lit(s).alias("system"), F.lit(c).alias("criterion"), F.col(f"eval_{s}.{c}").alias("score"))
            for s in systems
            for c in CRITERIA
        ]
    )
    return rated.select(F.col(key).cast("long").alias("sample_id"), F.explode(entries).alias("e")).select(
        "sample_id", "e.*"
    )


def human_scores(ratings: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """Mean per system and criterion, and the mean of those means as ``average``."""
    score = F.when(F.col("score") > 0, F.col("score")) if zero_is_missing else F.col("score")
    means = ratings.groupBy("system").agg(
        *[F.avg(F.when(F.col("criterion") == c, score)).alias(c) for c in CRITERIA]
    )
    # the mean over the criteria that have one
    present = F.filter(F.array(*CRITERIA), lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return means.withColumn("average", F.when(F.size(present) > 0, total / F.size(present)))


def score_levels(ratings: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """Means per system and criterion, per system, per criterion and over all, from one pass.

    ``level`` tells them apart; a column that a level sums over is null, and so is a mean
    of nothing but unrated entries.
    """
    score = F.when(F.col("score") > 0, F.col("score")) if zero_is_missing else F.col("score")
    sets = [["system", "criterion"], ["system"], ["criterion"], []]
    # the two bits of the grouping id: 2 without system, 1 without criterion
    names = F.element_at(F.array(*[F.lit(n) for n in ("both", "system", "criterion", "all")]), (F.grouping_id() + 1).cast("int"))
    return ratings.groupingSets([[F.col(c) for c in s] for s in sets], "system", "criterion").agg(
        names.alias("level"), F.avg(score).alias("mean"), F.count(score).alias("rated"), F.count(F.lit(1)).alias("entries")
    )


def prompt_scores(ratings: DataFrame, systems: tuple[str, ...]) -> DataFrame:
    """Mean rating per sample, zeros counted, one column per system."""
    return ratings.groupBy("sample_id").agg(
        *[F.avg(F.when(F.col("system") == s, F.col("score"))).alias(f"mean_{s}") for s in systems]
    )
