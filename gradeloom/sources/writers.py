"""Writers: splits, evaluation sets, result records, tables and annotation sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import schemas
from gradeloom.functions.text import preview
from gradeloom.operators.ratings import annotation_sheet
from gradeloom.operators.splits import head
from gradeloom.session import sparing

# Rows and characters of the stored previews.
PREVIEW_ROWS, PREVIEW_CHARS = 10, 200
# Samples repeat a reference with every model; a fast compression finds that.
SMALL_FILES = {"compression": "gzip", "zlib.compress.level": "THREE"}


def save_splits(splits: DataFrame, root: str, json_root: str | None = None) -> None:
    """Columnar copy partitioned by split and, on request, JSON lines per split.

    The JSON copy is read back from the columnar one, so the split is computed once.
    """
    splits.write.mode("errorifexists").partitionBy("split").parquet(root)
    if json_root is not None:
        saved = splits.sparkSession.read.parquet(root)
        saved.write.mode("errorifexists").partitionBy("split").json(json_root)


def save_eval_set(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").json(path)


def benchmark_record(summary: DataFrame) -> DataFrame:
    """A summary row as the nested benchmark record; figures it lacks become null."""

    def figure(name: str, source: str):
        return (F.col(source) if source in summary.columns else F.lit(None)).cast("double").alias(name)

    def setting(name: str):
        return (F.col(name) if name in summary.columns else F.lit(None)).cast("int").alias(name)

    def label(name: str):
        return (F.col(name) if name in summary.columns else F.lit(None)).cast("string").alias(name)

    return summary.select(
        "framework", label("timestamp"), label("model_path"),
        F.struct(*[setting(c) for c in ("num_prompts", "num_trials", "max_new_tokens")]).alias("config"),
        F.struct(
            figure("avg_latency_s", "avg_latency_s"),
            figure("std_latency_s", "std_latency_s"),
            figure("avg_tokens_generated", "avg_tokens_generated"),
            figure("avg_throughput_tokens_per_s", "avg_throughput"),
            figure("std_throughput", "std_throughput"),
            figure("peak_memory_gb", "peak_memory_gb"),
            figure("load_time_s", "load_time_s"),
        ).alias("results"),
    )


# Figures of a summary under the names of the full record.
RECORDED = {
    "avg_latency_s": "avg_latency_seconds", "min_latency_s": "min_latency_seconds", "max_latency_s": "max_latency_seconds",
    "p50_latency_s": "p50_latency_seconds", "p90_latency_s": "p90_latency_seconds", "p99_latency_s": "p99_latency_seconds",
    "avg_throughput": "avg_throughput_tokens_per_sec", "total_tokens": "total_tokens_generated", "num_requests": "num_prompts",
    "total_time_s": "total_benchmark_time_seconds",
}


def full_benchmark_record(summary: DataFrame, **settings) -> DataFrame:
    """A summary row as the record that holds every figure; ``settings`` are columns of one value.

    Columns that neither gives are null. An unknown setting raises an error.
    """
    schema = T.StructType.fromDDL(schemas.BENCH_RECORD)
    unknown = set(settings) - set(schema.names)
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}; known: {schema.names}")
    named = summary.withColumnsRenamed({old: new for old, new in RECORDED.items() if old in summary.columns})

    def column(field: T.StructField):
        value = F.lit(settings[field.name]) if field.name in settings else F.col(field.name) if field.name in named.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return named.select(*[column(field) for field in schema.fields])


def evaluation_record(card: DataFrame) -> DataFrame:
    """A scorecard row as the nested evaluation record; the headline BLEU is the one of four-grams."""
    metrics = [c for c in card.columns if c.startswith(("bleu", "rouge", "bertscore"))]
    headline = [F.col("bleu_4").alias("bleu")] if "bleu_4" in metrics and "bleu" not in metrics else []

    def given(name: str, kind: str):
        return (F.col(name) if name in card.columns else F.lit(None)).cast(kind).alias(name)

    return card.select(
        F.col("model").alias("model_name"), given("model_path", "string"), given("timestamp", "string"),
        F.col("num_samples").cast("int").alias("num_samples"), given("generation_time_s", "double"),
        F.struct(*headline, *metrics).alias("metrics"),
    )


def save_records(records: DataFrame, path: str, one_per_file: bool = False, **options: str) -> None:
    """Result records as JSON under a path that does not exist yet.

    ``one_per_file`` gives each record its own file, as result readers expect;
    ``options`` are the writer's, for example its compression.
    """
    writer = records.write.mode("errorifexists").options(**options)
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    with sparing(records.sparkSession):
        writer.json(path)


def save_comparison(table: DataFrame, path: str) -> None:
    """A small comparison table as one CSV with a header."""
    table.coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def sample_previews(pairs: DataFrame, rows: int = PREVIEW_ROWS, chars: int = PREVIEW_CHARS) -> DataFrame:
    """The first rows with their texts cut to the preview length."""
    texts = ("prompt", "reference", "generated")
    return head(pairs, rows).select("id", *[preview(c, chars).alias(c) for c in texts])


def save_for_annotation(samples: DataFrame, path: str) -> None:
    annotation_sheet(samples).write.mode("errorifexists").json(path)


def append_training_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("append").partitionBy("framework").json(path)
