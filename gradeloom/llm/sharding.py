"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals.

Rows are put in one global order (doc_id, size, checksum, input position) by a range
partitioning of narrow rows without texts. Totals per partition give each partition
its place in the global prefix sum; inside a partition a running sum completes it.
The middle byte of a row decides its shard, so shards are contiguous in that order
and differ from the equal target by at most one row's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import written

ROW_OVERHEAD = 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus a fixed overhead; a null text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def text_checksum(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, unsigned; a null text counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def shard_by_bytes(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``slot`` is the place inside the shard, from 0 without gaps. Null ids come first
    in the order; repeated rows follow each other and each takes its own slot. An
    empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    narrow = docs.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        text_checksum(F.col("text")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_at"),  # keeps a value held by many rows divisible into ranges
    )
    order = ["doc_id", "size", "text_crc32", "_at"]
    # written, because sampled range bounds may differ between two evaluations
    parts = written(
        narrow.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "shard-ranges"
    )

    # one row per range partition: as many as the shuffle has partitions
    totals = parts.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(by_part), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(by_part), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_total"),
    )

    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        parts.withColumn("_upto", F.sum("size").over(running))
        .withColumn("_row", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")
        .select(
            *order[:3],
            # the doubled middle byte against the doubled total: whole numbers only
            F.expr(
                f"cast(least(((2 * (_bytes_before + _upto) - size) * {int(shards)}L) div (2 * _total), {int(shards) - 1}L) as int)"
            ).alias("shard"),
            (F.col("_rows_before") + F.col("_row")).alias("_place"),
        )
    )
    starts = placed.groupBy("shard").agg(F.min("_place").alias("_start"))  # one row per shard
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_place") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
