"""Named queries over the input tables, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded and integers widened, so both engines report the same values and types."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), DIGITS)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart, left out where SQL cannot express it."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
