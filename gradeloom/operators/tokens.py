"""Vocabulary building, encoding, padding and token counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.overlap import encoded_tokens, one_dictionary
from gradeloom.functions.text import Splitter, Tokenizer, tokenize, tokenizer_named, words
from gradeloom.operators.prefix import global_rank
from gradeloom.session import written

# Special ids, padding and label conventions of the tokenizer.
UNK, BOS, EOS = 0, 1, 2
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>")
PAD = EOS
IGNORED_LABEL = -100
PAD_MULTIPLE = 8

VOCABULARY_LIMIT = 32000
#: Most bytes of a vocabulary that is sent to the workers.
VOCABULARY_BYTES = 256 << 20
#: Text bytes of a block that is encoded with its own part of a larger vocabulary.
BLOCK_BYTES = 16 << 20


def build_vocabulary(df: DataFrame, text: str = "text", size: int = VOCABULARY_LIMIT, tokenizer: str = "whitespace") -> DataFrame:
    """The ``size`` most frequent tokens with ids after the special ones.

    Ranking is by count, then token. The final numbering sorts at most ``size`` rows.
    """
    counted = (
        df.select(F.explode(tokenize(text, tokenizer)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.desc("n"), F.asc("token")]
    numbered = F.row_number().over(Window.orderBy(*order)) + (len(SPECIAL_TOKENS) - 1)
    return counted.orderBy(*order).limit(size).select("token", "n", numbered.cast("int").alias("token_id"))


def _entries(vocabulary: DataFrame) -> DataFrame:
    """One id per token, the smallest."""
    return vocabulary.where("token IS NOT NULL").groupBy("token").agg(F.min("token_id").cast("int").alias("token_id"))


class _LookUp:
    """Ids of prepared texts by a list of tokens."""

    def __init__(self, splitter: Splitter, names: pa.Array, ids: np.ndarray):
        self.splitter, self.names, self.ids = splitter, names, np.append(ids, UNK).astype(np.int32)

    def __call__(self, texts: pa.Array) -> pa.Array:
        encoded, lengths = encoded_tokens(texts, self.splitter)
        codes, words = one_dictionary(encoded)
        known = pc.fill_null(pc.index_in(words, value_set=self.names), len(self.names))
        per_token = self.ids[known.to_numpy(zero_copy_only=False)]
        # every text starts with the start id
        starts = np.concatenate([[0], np.cumsum(lengths)])
        values = np.insert(per_token[codes], starts[:-1], BOS)
        offsets = pa.array((starts + np.arange(len(starts))).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def _names(table: pa.Table) -> pa.Array:
    return table.column("token").combine_chunks().cast(pa.large_string())


def _encode_shipped(df: DataFrame, entries: DataFrame, text: str, rule: Tokenizer) -> DataFrame:
    """The vocabulary goes to every worker; nothing is shuffled."""
    splitter, fetched = rule.splitter, entries.toArrow()
    shipped = df.sparkSession.sparkContext.broadcast((_names(fetched), fetched.column("token_id").to_numpy()))

    def look_up(texts: pa.Array) -> pa.Array:
        return _LookUp(splitter, *shipped.value)(texts)

    return df.withColumn("input_ids", F.arrow_udf(look_up, "array<int>")(rule.prepare(F.col(text))))


def _encode_joined(df: DataFrame, entries: DataFrame, text: str, tokenizer: str, block_bytes: int) -> DataFrame:
    """The distinct tokens of a block of texts fetch their ids in one join, for vocabularies of any size.

    Rows are written once, numbered and dealt to blocks of about ``block_bytes`` of text. A
    frequent token asks once per block.
    """
    rule = tokenizer_named(tokenizer)
    numbered = written(df.withColumns({"_text": rule.prepare(F.col(text)), "_row": F.monotonically_increasing_id()}), "encode-rows")
    total = numbered.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = numbered.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    asked = dealt.select("_block", F.explode(F.array_distinct(tokenize(text, tokenizer))).alias("token")).distinct()
    found = asked.join(entries, "token").select(F.col("_block").alias("_at"), "token", "token_id")
    splitter, columns = rule.splitter, df.columns

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        ids = _LookUp(splitter, _names(known), known.column("token_id").to_numpy())(rows.column("_text").combine_chunks())
        return rows.select(columns).append_column("input_ids", ids)

    schema = T.StructType([*df.schema.fields, T.StructField("input_ids", T.ArrayType(T.IntegerType()))])
    return dealt.groupBy("_block").cogroup(found.groupBy("_at")).applyInArrow(look_up, schema)


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    text: str = "text",
    max_length: int | None = None,
    tokenizer: str = "whitespace",
    max_vocabulary_bytes: int = VOCABULARY_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels``.

    A start id is put in front, no end id; unknown tokens get the unknown id, tokens
    listed twice their smaller one; ``max_length`` cuts the ids when given; labels
    repeat the ids. A vocabulary of up to ``max_vocabulary_bytes`` (some ten million
    tokens) goes to every worker and is looked up per Arrow batch; a larger one is joined
    per block of texts, with the same result.
    """
    entries = written(_entries(vocabulary), "vocabulary")  # read for its size and for its rows
    size = entries.agg(F.coalesce(F.sum(F.octet_length("token") + 8), F.lit(0))).first()[0]
    if size <= max_vocabulary_bytes:
        encoded = _encode_shipped(df, entries, text, tokenizer_named(tokenizer))
    else:
        encoded = _encode_joined(df, entries, text, tokenizer, block_bytes)
    if max_length is not None:
        encoded = encoded.withColumn("input_ids", F.slice("input_ids", 1, max_length))
    return encoded.withColumns(
        {
            "attention_mask": F.array_repeat(F.lit(1), F.size("input_ids")),
            "labels": F.col("input_ids"),
        }
    )


def _padded(ids: Column, filler: int, to: Column) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(filler), (to - F.size(ids)).cast("int")))


def padded_batches(encoded: DataFrame, batch_size: int, seed: int | str) -> DataFrame:
    """Shuffled batches padded to their longest row, rounded up to a multiple of eight."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    target = (F.ceil(F.col("_longest") / PAD_MULTIPLE) * PAD_MULTIPLE).cast("int")
    return (
        global_rank(encoded.select("id", "input_ids"), seed)
        .withColumn("batch_id", F.floor((F.col("rank") - 1) / batch_size))
        .withColumn("_longest", longest)
        .withColumn("padded_length", target)
        .withColumn("num_tokens", F.size("input_ids"))
        # masks and labels follow from the ids, so only these are shuffled
        .withColumns(
            {
                "attention_mask": _padded(F.array_repeat(F.lit(1), F.size("input_ids")), 0, F.col("padded_length")),
                "labels": _padded(F.col("input_ids"), IGNORED_LABEL, F.col("padded_length")),
                "input_ids": _padded(F.col("input_ids"), PAD, F.col("padded_length")),
            }
        )
        .drop("_longest")
    )


def padding_waste(batches: DataFrame) -> DataFrame:
    """Share of padded positions over all batches."""
    return batches.agg(
        F.count_distinct("batch_id").alias("num_batches"),
        F.sum("padded_length").alias("positions"),
        F.sum("num_tokens").alias("tokens"),
        (1 - F.sum("num_tokens") / F.sum("padded_length")).alias("waste"),
    )


def with_token_count(df: DataFrame, tokenizer: str = "whitespace") -> DataFrame:
    """Tokens of instruction, context and response joined by spaces, start id included."""
    joined = F.concat_ws(" ", "instruction", "context", "response")
    return df.withColumn("total_tokens", (F.size(tokenize(joined, tokenizer)) + 1).cast("long"))


def estimated_tokens(text: Column, max_new_tokens: int) -> Column:
    """A quarter of the characters, at least 1 and at most the generation limit."""
    return F.greatest(F.lit(1), F.least(F.floor(F.length(text) / 4), F.lit(max_new_tokens)))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def steps_per_epoch(rows: Column, per_device_batch: int = 2, accumulation: int = 8) -> Column:
    return F.ceil(rows / (per_device_batch * accumulation))
