"""Shared pieces of the pipeline operators: tables, written intermediates, Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gradeloom.session import shared_folder

SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, with ``options`` of the writer, and read again.

    Cuts the lineage at files that every executor can reach, so a lost executor
    costs no recomputation of what stands before.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that only a few texts are Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
