"""The registered queries of the pipeline operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import (
    alignment,
    byte_bpe,
    language_model,
    lexical_search,
    main_text,
    near_copies,
    packing,
    private_data,
    quality_classifier,
    quality_rules,
    sharding,
    vector_search,
    warc,
)
from gradeloom.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score_documents(docs, model)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode_and_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find_private(table(spark, sf_dir, "documents")).drop("spans_list")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths)


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_sharding,
        op3_byte_bpe,
        op4_nearest_neighbours,
        op5_warc,
        op6_personal_data,
        op7_main_text,
        op8_packing,
        op9_quality_rules,
        op10_near_copies,
        op11_alignment,
        op12_language_model,
        op13_lexical_search,
    )
}

SQL: dict[str, str] = {"op13_lexical_search": lexical_search.SQL}
