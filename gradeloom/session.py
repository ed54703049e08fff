"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", app: str = "gradeloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session with the settings the library is tested under."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared folder, ``spark.checkpoint.dir``.

    Where that is not set, a folder below ``spark.sql.warehouse.dir``, which a session's
    driver and executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Bytes that Python gets at once of what is written.
BATCH_BYTES = 8 << 20


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """What is written inside takes less disk and memory.

    Its shuffle files are removed as soon as it is written; otherwise they stay until the driver happens
    to collect its garbage. Python gets it in batches of few bytes, however long the rows are.
    """
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {name: spark.conf.get(name) for name in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", batch)}
    given = int(before[batch].rstrip("b")) if before[batch].rstrip("b").isdigit() else -1
    settings = dict.fromkeys(before, "true") | {batch: str(min(given, BATCH_BYTES) if given > 0 else BATCH_BYTES)}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, with ``options`` of the writer, and read again.

    For results that must be computed once: rows numbered on the way, answers of a model.
    """
    path = shared_folder(df.sparkSession, purpose)
    with sparing(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on group keys in which null is a key like any other; the keys come from ``left``."""
    renamed = right.withColumnsRenamed({key: f"_of_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    return left.join(renamed, same, how).drop(*[f"_of_{key}" for key in keys])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan that has fewer splits than the cluster has cores.

    One small file arrives as one task, which would run all row-local work on
    one core. Inputs with enough splits keep their layout and are not shuffled.
    The partition count is given, because an open one would be coalesced by size
    alone, while row-local text work is bound by computation.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # more than one task per core evens out texts of very different length
    return df.repartition(2 * cores, *keys)


def small_side(summary: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A per-group summary as local rows when it has at most ``max_rows`` of them.

    Local rows have a known size, so the planner broadcasts them by its own
    threshold; a longer summary is returned as it is and joined by shuffle.
    """
    rows = summary.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return summary
    return summary.sparkSession.createDataFrame(rows, summary.schema)
