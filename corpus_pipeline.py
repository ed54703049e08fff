"""A training-data pipeline over ``documents``: five stages, each written and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All
but the last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import near_copies, packing, private_data, quality_classifier, quality_rules
from gradeloom.llm.catalog import TOKENIZER
from gradeloom.llm.common import table, written


#: Numbers the rows of a stage's input; ids may be missing or shared.
ROW = "_pipeline_row"


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be good."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.keep_good(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, by SimHash as its own query links them, the row with the smallest id.

    Rows without an id come last. Rows are told apart by a key that is written once, so these, or of one id
    with unlike texts, are judged by their texts like all others.
    """
    rows = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    groups = near_copies.near_copies(rows.select(F.col(ROW).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(ROW), "component_id")
    ids = rows.select(ROW, "doc_id").join(groups, ROW)
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW)).alias("first"))
    chosen = written(first.select(F.col("first")[ROW].alias(ROW)), "pipeline-first")
    # keys grow with the rows, so they are never broadcast; a partition's keys fit in memory, its texts need no sort
    return rows.join(chosen.hint("shuffle_hash"), ROW, "left_semi").select(docs.columns)


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data masked, and its length brought up to date."""
    text = private_data.masked_text()(F.col("text"))
    return docs.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("near_copies", near_copies_stage),
    ("private_data", private_data_stage),
    ("packing", packing_stage),
]

#: The stages are not expressible in SQL; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
