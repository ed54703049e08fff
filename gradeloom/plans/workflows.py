"""End-to-end jobs: prepare a dataset, evaluate models, summarise a benchmark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.templates import apply_template, evaluation_rows
from gradeloom.functions.text import strip_prompt
from gradeloom.operators import compare, generate, matching, profile, quality, requests, splits
from gradeloom.session import written
from gradeloom.sources import readers, versions, writers


def prepare_dataset(instructions: DataFrame, root: str, template: str = "chat", seed: int = splits.SEED, **quotas) -> DataFrame:
    """Split, format, save and describe an instruction table.

    The split is computed once, on its way into the saved table; everything else
    reads that table. Returns the statistics per split.
    """
    spark = instructions.sparkSession
    made = apply_template(splits.create_splits(instructions, seed, **quotas), template)
    writers.save_splits(made, f"{root}/splits", f"{root}/splits-json")
    test = readers.read_splits(spark, f"{root}/splits", "test")
    writers.save_eval_set(evaluation_rows(test), f"{root}/test-eval")
    return profile.dataset_stats(readers.read_splits(spark, f"{root}/splits"))


def generate_answers(rows: DataFrame, model: str, engine: str | generate.EngineFactory, **options) -> DataFrame:
    """Predictions of one engine for evaluation rows, the echoed prompt cut off.

    Answers are written once and read back, so whatever is derived from them agrees.
    """
    made = written(generate.batch_generate(rows.select("id", "prompt"), engine, **options), "answers")
    return made.select(
        F.lit(model).alias("model"), "id", strip_prompt("text", "prompt").alias("prediction"),
        "tokens_generated", "latency_s", "status",
    )


def evaluate(
    predictions: DataFrame,
    references: DataFrame,
    vectors: DataFrame | None = None,
    metrics: Sequence[str] = ("bleu", "rouge"),
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Scored pairs and the scorecard per model; BERTScore joins in when vectors are given."""
    pairs = quality.pair_predictions(predictions, references)
    scored = quality.score_pairs(pairs, metrics, **options)
    if vectors is not None:
        scored = matching.match_tokens(scored, vectors)
    return scored, quality.scorecard(scored)


def rescore(
    samples: DataFrame, root: str, vectors: DataFrame | None = None, metrics: Sequence[str] = ("bleu", "rouge"), **options
) -> int:
    """Score stored samples again and publish the scores as a new version of the score table below ``root``.

    New figures replace old ones by model and id; figures and rows that are not scored again
    stay. Returns the version; one that fails is not published.
    """
    scored = quality.score_pairs(samples, metrics, **options)
    if vectors is not None:
        kept = [c for c in scored.columns if c not in ("prediction", "reference")]
        scored = matching.match_tokens(scored, vectors, kept=kept)
    return versions.upsert_version(scored.drop("prediction", "reference"), root, ("model", "id"))


def compare_models(card: DataFrame, baseline: str, models: Sequence[str]) -> dict[str, DataFrame]:
    """Comparison matrix, winners and change against the baseline, from a scorecard."""
    metrics = quality.score_columns(card)
    long = compare.unpivot(card, "model", metrics)
    return {
        "matrix": compare.comparison_matrix(card, models, metrics),
        "best": compare.best_per_metric(long, order=models),
        "before_after": compare.before_after(card, baseline, metrics),
    }


def summarise_benchmark(log: DataFrame, baseline: str, frameworks: Sequence[str], warmup: int = requests.WARMUP) -> dict[str, DataFrame]:
    """Summary, display table, winners and speed-up of a request log, warm-up left out."""
    summary = requests.std_from_p90(requests.benchmark_summary(requests.drop_warmup(log, warmup)))
    figures = ("avg_latency_s", "avg_throughput", "peak_memory_gb")
    long = compare.unpivot(summary, "framework", figures)
    return {
        "summary": summary,
        "table": requests.display_table(summary),
        "winners": compare.best_per_metric(long, "framework", ("avg_latency_s", "peak_memory_gb"), frameworks),
        "speedup": compare.speedup(summary, baseline),
        "records": writers.benchmark_record(summary),
    }
