"""Seeded shuffles, exact-quota splits, holdouts and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.prefix import global_rank, shuffle_key
from gradeloom.session import join_groups

# Default seed and split quotas.
SEED = 42
TRAIN, VALIDATION, TEST = 12000, 2000, 1000
HOLDOUT = 1000


def split_sizes(
    rows: int,
    train: int = TRAIN,
    validation: int = VALIDATION,
    test: int = TEST,
    max_samples: int | None = None,
    shares: bool = False,
) -> tuple[int, int, int]:
    """Quotas after optional down-sampling and shrinking to the rows at hand.

    Train and validation scale down with truncation; test takes the remainder. With
    ``shares`` the numbers are proportions, and larger tables are split whole as well.
    """

    def scaled(total: int, a: int, b: int, c: int) -> tuple[int, int, int]:
        ratio = total / (a + b + c)
        a, b = int(a * ratio), int(b * ratio)
        return a, b, total - a - b

    sizes = (train, validation, test)
    if max_samples is not None:
        sizes = scaled(max_samples, *sizes)
    if rows < sum(sizes) or (shares and max_samples is None):
        sizes = scaled(rows, *sizes)
    return sizes


def seeded_shuffle(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row with its position in the seeded order, as ``rank``."""
    return global_rank(df, seed)


def select_range(ranked: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows at positions start..stop-1, counted from zero."""
    return ranked.where((F.col("rank") > start) & (F.col("rank") <= stop))


def create_splits(
    df: DataFrame,
    seed: int = SEED,
    train: int = TRAIN,
    validation: int = VALIDATION,
    test: int = TEST,
    max_samples: int | None = None,
    shares: bool = False,
) -> DataFrame:
    """Rows of the three splits with a ``split`` column; surplus rows drop out by quota.

    With ``shares`` the quotas are proportions and no row drops out.

    The only action is the row count that the quota rule needs.
    """
    n_train, n_val, n_test = split_sizes(df.count(), train, validation, test, max_samples, shares)
    rank = F.col("rank")
    return (
        global_rank(df, seed, upto=n_train + n_val + n_test)
        .where(rank <= n_train + n_val + n_test)
        .withColumn(
            "split",
            F.when(rank <= n_train, "train").when(rank <= n_train + n_val, "validation").otherwise("test"),
        )
        .drop("rank")
    )


def tail_holdout(df: DataFrame, n: int, tail: int = HOLDOUT) -> DataFrame:
    """First ``n`` of the last ``tail`` rows in id order; two top-k passes, no full sort."""
    return df.orderBy(F.desc("id")).limit(tail).orderBy("id").limit(n)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy("id").limit(n)


def seeded_sample(df: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """``k`` rows without replacement (all rows when there are fewer), by seeded key."""
    return (
        df.withColumn("_key", shuffle_key(seed)).orderBy("_key", "id").limit(k).drop("_key")
    )


def number_sample(sample: DataFrame, seed: int = SEED) -> DataFrame:
    """Sample rows numbered 1..k in draw order; the input is a k-row sample."""
    order = Window.orderBy(shuffle_key(seed), "id")
    return sample.withColumn("sample_no", F.row_number().over(order).cast("long"))


def first_per_category(df: DataFrame, categories: int | None = 3) -> DataFrame:
    """The first row of each category, categories in order of appearance.

    First ids are found without the rows; of rows that repeat a first id one is kept.
    """
    firsts = df.groupBy("category").agg(F.min("id").alias("id"))
    if categories is not None:
        firsts = firsts.orderBy("id").limit(categories)
    found = join_groups(df, firsts, ["category", "id"], "left_semi").dropDuplicates(["category"])
    return found if categories is None else found.orderBy("id")


def cycle_to(ranked: DataFrame, size: int, n: int) -> DataFrame:
    """Repeat a ranked list of ``size`` rows until ``n`` rows exist: row i is entry i mod size."""
    first = F.col("rank") - 1
    return ranked.where(first < n).withColumn("position", F.explode(F.sequence(first, F.lit(n - 1).cast("long"), F.lit(size).cast("long"))))


def repeat_trials(df: DataFrame, trials: int) -> DataFrame:
    """Every row once per trial, numbered from 1."""
    return df.withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(trials))))
