"""The library's input tables, derived from the tables at hand.

Each derivation has a Spark form here and a SQL form in ``plans.sql``; both use
whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions.overlap import encoded_tokens, one_dictionary
from gradeloom.functions.text import Splitter
from gradeloom.operators.runs import number_steps
from gradeloom.schemas import CRITERIA
from gradeloom.session import spread

MODELS = ("base", "drop3", "half")
FRAMEWORKS = ("click", "error", "purchase", "signup", "view")
SYSTEMS = ("a", "b")
BY_BLANK = Splitter(" +", bytes(b for b in range(256) if b != ord(" ")))
# Set-up scores of the chart.
SETUP_EASE = {"click": 0.7, "error": 0.8, "purchase": 0.5, "view": 0.9}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instructions(spark: SparkSession, sf_dir: str, by_id: bool = False) -> DataFrame:
    """INSTRUCT: the words of a document as instruction, context and response.

    The first twelve words instruct; the next forty-eight are context for documents
    that have one; everything after is the response. Some contexts are empty, some blank.
    ``by_id`` lays the rows out by id, so that what derives from them joins with them
    by id without moving: a text is shuffled once, not with each of its predictions.
    """
    scan = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    documents = spread(scan, "doc_id")
    ws = F.array_remove(F.split("text", "[ \\n\\t\\r]+"), "")
    empty = F.col("doc_id") % 3 == 0
    blank = (F.col("doc_id") % 3 == 1) & (F.col("doc_id") % 2 == 0)
    rest = F.when(empty | blank, 13).otherwise(61)
    count = F.greatest(F.size("ws") - rest + 1, F.lit(0))
    instruct = documents.withColumn("ws", ws).select(
        F.col("doc_id").alias("id"),
        F.array_join(F.slice("ws", 1, 12), " ").alias("instruction"),
        F.when(empty, "").when(blank, " ").otherwise(F.array_join(F.slice("ws", 13, 48), " ")).alias("context"),
        F.array_join(F.slice("ws", rest, count), " ").alias("response"),
        F.col("lang").alias("category"),
    )
    return instruct.repartition("id") if by_id and documents is scan else instruct


def predictions(instruct: DataFrame) -> DataFrame:
    """PREDICTION: three stand-in models that rearrange or thin out the response."""
    ws = F.array_remove(F.split("response", " "), "")
    base = F.array_join(F.reverse("ws"), " ")
    drop3 = F.array_join(F.filter("ws", lambda x, i: (i + 1) % 3 != 0), " ")
    half = F.array_join(F.slice("ws", 1, F.ceil(F.size("ws") / 2).cast("int")), " ")
    texts = F.array(
        *[F.struct(F.lit(m).alias("model"), c.alias("prediction")) for m, c in zip(MODELS, (base, drop3, half))]
    )
    return instruct.select("id", ws.alias("ws")).select("id", F.explode(texts).alias("p")).select(
        "p.model", "id", "p.prediction"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REQUEST: events as a log of generation requests."""
    return as_requests(table(spark, sf_dir, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("framework"),
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("latency_s"),
        F.get_json_object("props", "$.k").cast("int").alias("tokens_generated"),
        F.when(F.col("event_type") != "signup", 1 + F.col("user_id") % 12).cast("double").alias("memory_used_gb"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RATING: two systems, three criteria, scores 0..5 where 0 is unrated."""
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("system"), F.lit(c).alias("criterion"),
                ((F.col("doc_id") * 7 + F.col("quality") * 3 + F.col("toxic") + i * len(CRITERIA) + j) % 6)
                .cast("int").alias("score"),
            )
            for i, s in enumerate(SYSTEMS)
            for j, c in enumerate(CRITERIA)
        ]
    )
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("sample_id"), F.explode(entries).alias("e")).select("sample_id", "e.*")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUN: events as training runs that kept some of their outputs."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("framework"),
        F.date_format("ts", "yyyyMMdd_HHmmss").alias("run_id"),
        F.col("event_id").alias("tie_break"),
        (F.col("user_id") % 2 == 0).alias("has_merged"),
        (F.col("user_id") % 3 != 0).alias("has_adapter"),
        (F.col("user_id") % 5 != 0).alias("has_stats"),
    )


def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVAL_LOG: each user's events as one run's evaluation losses."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.col("value").alias("eval_loss"),
    )
    return number_steps(events, "run", "ts", "event_id").select("run", "step", "eval_loss")


def training_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training figures per run, one run per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("framework"),
        F.col("event_id").alias("run_no"),
        (F.col("value") * 60).alias("training_time_seconds"),
        F.lit(2).alias("per_device_batch"),
        (F.col("user_id") % 8 + 1).alias("accumulation_steps"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words between blanks of a batch of texts."""
    for batch in batches:
        if batch.num_rows:
            _, words = one_dictionary(encoded_tokens(batch.column(0), BY_BLANK)[0])
            yield pa.RecordBatch.from_arrays([words.cast(pa.string())], names=["token"])


def token_vectors(spark: SparkSession, sf_dir: str, instruct: DataFrame) -> DataFrame:
    """TOKEN_VEC: every distinct response word with the embedding its hash points to."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    size = embeddings.agg(F.count(F.lit(1)).alias("n"))
    tokens = instruct.select(F.lower("response").alias("token")).mapInArrow(_distinct_words, "token STRING").distinct()
    slot = F.conv(F.substring(F.md5("token"), 1, 6), 16, 10).cast("long") % size.scalar()
    return tokens.withColumn("vec_id", slot).join(embeddings, "vec_id").select("token", "vec")
