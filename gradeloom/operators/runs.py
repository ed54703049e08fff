"""Training runs: latest run selection, derived figures, early stopping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.prefix import running
from gradeloom.session import join_groups

# Early-stopping patience; run-id pattern; steps per running chunk.
PATIENCE = 3
RUN_ID_FORMAT = "yyyyMMdd_HHmmss"
CHUNK_STEPS = 65536


def _newest(runs: DataFrame, *carried: str) -> DataFrame:
    """The row with the greatest (run_id, tie_break) per framework."""
    order = F.struct("run_id", *([c for c in ("tie_break",) if c in runs.columns]))
    return runs.groupBy("framework").agg(F.max_by(F.struct("run_id", *carried), order).alias("_r")).select(
        "framework", "_r.*"
    )


def latest_model(runs: DataFrame) -> DataFrame:
    """Newest run per framework that has a model, merged preferred over adapter."""
    usable = runs.where("has_merged OR has_adapter")
    newest = _newest(usable, "has_merged")
    kind = F.when(F.col("has_merged"), "merged_model").otherwise("adapter")
    return newest.select(
        "framework", "run_id", kind.alias("kind"),
        F.concat_ws("/", F.lit("outputs"), "framework", "run_id", kind).alias("path"),
    )


def latest_stats(runs: DataFrame) -> DataFrame:
    """Newest run per framework, kept only if that very run has statistics."""
    return _newest(runs, "has_stats").where("has_stats").select("framework", "run_id")


def run_time(run_id: Column) -> Column:
    return F.to_timestamp(run_id, RUN_ID_FORMAT)


def training_figures(stats: DataFrame) -> DataFrame:
    """Minutes and effective batch size from seconds, device batch and accumulation."""
    return stats.withColumns(
        {
            "training_time_minutes": F.col("training_time_seconds") / 60,
            "effective_batch_size": F.col("per_device_batch") * F.col("accumulation_steps"),
        }
    )


def early_stop(log: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """Stop step and best checkpoint per run from an evaluation-loss log.

    A step improves when its loss is below every earlier one. The run stops at
    the first step that lies ``patience`` steps after the last improvement; that
    improvement is its best checkpoint. Steps are dense from 1.

    Long runs are cut into chunks of steps. A chunk learns the lowest loss before
    it from the chunk minima, marks its own steps, and is reduced to one row where
    it stands; the rows of a run are then read in order.
    """
    chunk = F.floor((F.col("step") - 1) / CHUNK_STEPS)
    chunked = log.select("run", "step", "eval_loss", chunk.alias("chunk"))
    before = Window.partitionBy("run").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    minima = (
        chunked.groupBy("run", "chunk").agg(F.min("eval_loss").alias("lowest"))
        .select("run", "chunk", F.min("lowest").over(before).alias("carried"))
    )
    inside = Window.partitionBy("run", "chunk").orderBy("step")
    earlier = F.least("carried", F.min("eval_loss").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    improved = F.col("earlier").isNull() | (F.col("eval_loss") < F.col("earlier"))
    last = F.max(F.when(improved, F.col("step"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    stalled = F.col("step") - F.col("last") >= patience
    chunks = (
        chunked.join(minima, ["run", "chunk"])
        .withColumn("earlier", earlier)
        .withColumn("last", last)
        .groupBy("run", "chunk", "carried")
        .agg(
            F.min("step").alias("first_step"),
            F.max("step").alias("last_step"),
            F.min("last").alias("first_gain"),
            F.max("last").alias("last_gain"),
            F.min(F.when(stalled, F.struct("step", F.col("earlier").alias("loss")))).alias("stop"),
            F.min("eval_loss").alias("lowest"),
        )
    )
    # steps at the head of a chunk may still wait for an improvement from before it
    waiting = F.col("gain_before") + patience
    head = (waiting >= F.col("first_step")) & (waiting <= F.col("last_step")) & (
        F.col("first_gain").isNull() | (waiting < F.col("first_gain"))
    )
    stops = chunks.withColumn("gain_before", F.max("last_gain").over(before)).withColumn(
        "stop", F.when(head, F.struct(waiting.alias("step"), F.col("carried").alias("loss"))).otherwise(F.col("stop"))
    )
    stop = F.min("stop")
    return stops.groupBy("run").agg(
        stop["step"].alias("stop_step"),
        F.coalesce(stop["step"] - patience, F.max("last_gain")).alias("best_step"),
        F.coalesce(stop["loss"], F.min("lowest")).alias("best_loss"),
        F.max("last_step").alias("num_steps"),
    )


def step_chunks(log: DataFrame, run: str, ts: str, tie: str, most: int = CHUNK_STEPS) -> DataFrame:
    """``log`` with ``_chunk``, which follows (``ts``, ``tie``) within a run and has at most ``most`` rows.

    A chunk is an hour; an hour with more rows falls into seconds, a second with more into
    single times and blocks of the (unique, whole) ``tie``. Only the crowded hours and
    seconds are told to the rows, and these are fewer than the rows divided by ``most``.
    """
    timed = log.withColumns({"_hour": F.date_trunc("hour", F.col(ts)), "_second": F.date_trunc("second", F.col(ts))})
    seconds = timed.groupBy(run, "_hour", "_second").agg(F.count(F.lit(1)).alias("_n"))
    full_hours = seconds.groupBy(run, "_hour").agg(F.sum("_n").alias("_in_hour")).where(F.col("_in_hour") > most)
    full_seconds = seconds.where(F.col("_n") > most).select(run, "_second", F.col("_n").alias("_in_second"))
    marked = join_groups(join_groups(timed, full_hours, [run, "_hour"], "left"), full_seconds, [run, "_second"], "left")
    none = F.lit(None)
    chunk = F.struct(
        F.col("_hour").alias("hour"),
        F.when(F.col("_in_hour").isNotNull(), F.col("_second")).otherwise(none).alias("second"),
        F.when(F.col("_in_second").isNotNull(), F.col(ts)).otherwise(none).alias("time"),
        F.when(F.col("_in_second").isNotNull(), F.floor(F.col(tie) / most)).otherwise(none).alias("block"),
    )
    return marked.withColumn("_chunk", chunk).drop("_hour", "_second", "_in_hour", "_in_second")


def number_steps(log: DataFrame, run: str, ts: str, tie: str, most: int = CHUNK_STEPS) -> DataFrame:
    """Dense step numbers per run from event times, whatever share of a run's events falls into one hour."""
    return running(step_chunks(log, run, ts, tie, most), [run], "_chunk", [ts, tie], tie, "count", "step").drop("_chunk")
