"""Text-quality scores of predictions against references: BLEU and ROUGE.

Input is a table of pairs with a ``prediction`` and a ``reference`` column.
Scores are columns on the same rows; nothing is shuffled until a summary.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.overlap import Count, overlap, overlap_counts
from gradeloom.functions.porter import rouge_stem
from gradeloom.functions.text import tokenize, tokenizer_named

# Smoothing constant of the first published sentence-BLEU smoothing method.
BLEU_EPSILON = 0.1

BLEU_COLUMNS = ("bleu_1", "bleu_2", "bleu_3", "bleu_4")
ROUGE_COLUMNS = (
    "rouge_1", "rouge_2", "rouge_l", "rouge_l_precision", "rouge_l_recall",
)
METRICS = {
    "bleu": BLEU_COLUMNS,
    "rouge": ROUGE_COLUMNS,
    "bleu_1": ("bleu_1",), "bleu_2": ("bleu_2",), "bleu_3": ("bleu_3",), "bleu_4": ("bleu_4",),
    "rouge_1": ("rouge_1",), "rouge_2": ("rouge_2",),
    "rouge_l": ("rouge_l", "rouge_l_precision", "rouge_l_recall"),
}


def pair_predictions(predictions: DataFrame, references: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Predictions with the reference of the same ``id``; rows without a partner drop out.

    With ``tokenizer`` each reference is prepared for it before it meets its predictions, as
    a column ``reference_<tokenizer>`` that ``score_pairs`` counts on and drops.
    """
    ready = [tokenizer_named(tokenizer).prepare(F.col("response")).alias(f"reference_{tokenizer}")] if tokenizer else []
    return predictions.join(references.select("id", F.col("response").alias("reference"), *ready), "id").select(
        "model", "id", "prediction", "reference", *[f"reference_{tokenizer}" for _ in ready]
    )


def attach_predictions(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """The result record of each scored sample."""
    return samples.join(predictions, "id").select(
        "model", "id", "instruction", "context", F.col("response").alias("reference"), "prediction", "category"
    )


def bleu_text(overlap: str, order: int) -> str:
    """Sentence BLEU with uniform weights over orders 1..order, as SQL over an overlap struct.

    The one form of the formula: score columns and the SQL function are both read from it.
    """
    o = overlap
    logs = " + ".join(
        f"ln(CASE WHEN {o}.m{n} > 0 THEN CAST({o}.m{n} AS DOUBLE) ELSE {BLEU_EPSILON}D END / greatest(1, {o}.pred_len - {n - 1})) / {order}"
        for n in range(1, order + 1)
    )
    brevity = f"CASE WHEN {o}.pred_len > {o}.ref_len THEN 1D ELSE exp(1 - {o}.ref_len / {o}.pred_len) END"
    return f"CASE WHEN {o}.m1 > 0 THEN {brevity} * exp({logs}) ELSE 0D END"


def rouge_l_text(overlap: str) -> str:
    """F1 of the longest common subsequence, as SQL over an overlap struct."""
    both = f"({overlap}.pred_len + {overlap}.ref_len)"
    return f"CASE WHEN {overlap}.lcs > 0 THEN 2 * {overlap}.lcs / {both} ELSE 0D END"


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def f_measure(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def rouge_n_columns(o: Column, n: int) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 of the shared n-grams."""
    p = _share(o[f"m{n}"], o["pred_len"] - (n - 1))
    r = _share(o[f"m{n}"], o["ref_len"] - (n - 1))
    return p, r, f_measure(p, r)


def rouge_l_columns(o: Column) -> tuple[Column, Column, Column]:
    p, r = _share(o["lcs"], o["pred_len"]), _share(o["lcs"], o["ref_len"])
    return p, r, f_measure(p, r)


def score_pairs(
    pairs: DataFrame,
    metrics: Sequence[str] = ("bleu", "rouge"),
    tokenizer: str = "whitespace",
    stem: bool = True,
    bleu_scale: float = 1.0,
) -> DataFrame:
    """Pairs plus the chosen score columns; unchosen scores are never computed."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; known: {sorted(METRICS)}")
    wanted = [c for m in metrics for c in METRICS[m]]
    bleu_orders = [n for n in range(1, 5) if f"bleu_{n}" in wanted]
    rouge_orders = [n for n in (1, 2) if f"rouge_{n}" in wanted]
    lcs = "rouge_l" in wanted
    ready = f"reference_{tokenizer}"
    kept = [c for c in pairs.columns if c != ready]
    parts = {}
    if bleu_orders:
        rule = tokenizer_named(tokenizer)
        reference = F.col(ready) if ready in pairs.columns else rule.prepare(F.col("reference"))
        parts["bleu"] = (rule.prepare(F.col("prediction")), reference, Count(rule.splitter, max(bleu_orders)))
    if rouge_orders or lcs:
        rule = tokenizer_named("alnum")
        count = Count(rule.splitter, max(rouge_orders, default=0), lcs, stem)
        parts["rouge"] = (rule.prepare(F.col("prediction")), rule.prepare(F.col("reference")), count)
    scored = pairs.withColumn("_overlap", overlap(parts))
    out: list[Column] = [F.col(c) for c in kept]
    for n in bleu_orders:
        out.append((F.expr(bleu_text("_overlap.bleu", n)) * bleu_scale).alias(f"bleu_{n}"))
    for n in rouge_orders:
        out.append(rouge_n_columns(F.col("_overlap.rouge"), n)[2].alias(f"rouge_{n}"))
    if lcs:
        names = ("rouge_l_precision", "rouge_l_recall", "rouge_l")
        out += [c.alias(name) for c, name in zip(rouge_l_columns(F.col("_overlap.rouge")), names)]
    return scored.select(*out)


def score_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("bleu_", "rouge_", "bertscore_"))]


def scorecard(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean of every score column per group, with the number of pairs behind it."""
    means = [F.avg(c).alias(c) for c in score_columns(scored)]
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("num_samples"), *means)


def word_stems(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``word, stem`` of every distinct ROUGE word of the text columns; a word is stemmed once."""

    @F.arrow_udf("string")
    def stems(words: pa.Array) -> pa.Array:
        return pa.array([rouge_stem(w) for w in words.to_pylist()], pa.string())

    words = F.concat(*[tokenize(c, "alnum") for c in columns])
    distinct = df.select(F.explode(F.array_distinct(words)).alias("word")).distinct()
    return distinct.withColumn("stem", stems("word"))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``bleu(prediction, reference)`` and ``rouge_l(prediction, reference)`` callable in SQL.

    BLEU-4 counts whitespace words, ROUGE-L is the F1 over unstemmed ROUGE words. Texts are
    prepared in the JVM as for the score columns, and a pair is counted once.
    """
    for name, tokenizer, shape, formula in (
        ("bleu", "whitespace", (4, False), bleu_text("o", 4)),
        ("rouge_l", "alnum", (0, True), rouge_l_text("o")),
    ):
        count = Count(tokenizer_named(tokenizer).splitter, *shape)
        fields = ", ".join(f"{f}: BIGINT" for f in count.fields)
        counted = F.arrow_udf(lambda p, r, count=count: overlap_counts(p, r, count), f"STRUCT<{fields}>")
        spark.udf.register(f"_{name}_overlap", counted)
        texts = "lower(coalesce(prediction, '')), lower(coalesce(reference, ''))"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(prediction STRING, reference STRING) RETURNS DOUBLE "
            f"RETURN transform(array(_{name}_overlap({texts})), o -> {formula})[0]"
        )
