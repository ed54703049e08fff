"""Streams: windowed request summaries and scoring of predictions as they land."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from gradeloom.operators.quality import score_pairs
from gradeloom.operators.requests import throughput
from gradeloom.session import shared_folder


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, name: str = "*.parquet") -> DataFrame:
    """A stream over parquet files of a folder whose names match ``name``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def request_windows(
    requests: DataFrame, window: str = "1 day", watermark: str = "1 hour", percentiles: bool = False
) -> DataFrame:
    """Latency and throughput per framework and tumbling window; rows later than the watermark drop out.

    State is one row per open window and framework. Percentiles come from a
    sketch, because exact ones would keep every value in state.
    """
    summary = {
        "num_requests": F.count(F.lit(1)),
        "avg_latency_s": F.avg("latency_s"),
        "max_latency_s": F.max("latency_s"),
        "avg_throughput": F.avg(throughput()),
        "total_tokens": F.sum("tokens_generated").cast("long"),
    }
    if percentiles:
        summary |= {
            f"p{int(p * 100)}_latency_s": F.percentile_approx("latency_s", p, 1000) for p in (0.5, 0.9, 0.99)
        }
    return (
        requests.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), "framework")
        .agg(*[c.alias(name) for name, c in summary.items()])
        .select(F.col("window.start").alias("window_start"), "framework", *summary)
    )


def score_stream(predictions: DataFrame, references: DataFrame, metrics: Sequence[str] = ("bleu", "rouge")) -> DataFrame:
    """Scores of streamed predictions against a static reference table; no state is kept."""
    pairs = predictions.join(references.select("id", F.col("response").alias("reference")), "id")
    return score_pairs(pairs.select("model", "id", "prediction", "reference"), metrics).drop("prediction", "reference")


def run_to_end(stream: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """Process what is available, write it to a fresh folder and return it as a batch table."""
    spark = stream.sparkSession
    target = shared_folder(spark, purpose)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", f"{target}/rows")
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{target}/rows")


def version_sink(target: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch of changed rows to a folder of its own below ``target``.

    A batch that runs again, after a lost driver or a replayed log, replaces its folder, so
    it counts once.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return save


def newest_rows(spark: SparkSession, target: str, schema: StructType, key: Sequence[str]) -> DataFrame:
    """Of every key the row of the latest batch that a ``version_sink`` holds.

    Batches are pre-aggregated where they are read; one row per key and task is shuffled.
    """
    kept = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(kept).parquet(target)
    values = [c for c in schema.names if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*values), "batch").alias("newest"))
    return newest.select(*[F.col(c) if c in key else F.col(f"newest.{c}").alias(c) for c in schema.names])


def run_updates(stream: DataFrame, purpose: str, key: Sequence[str]) -> DataFrame:
    """Process what is available in update mode and return the newest row of every key.

    Unlike ``append``, which reports a window when the watermark has passed its end, this
    reports the windows that are still open as well.
    """
    spark = stream.sparkSession
    target = shared_folder(spark, purpose)
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(version_sink(f"{target}/rows"))
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return newest_rows(spark, f"{target}/rows", stream.schema, key)
