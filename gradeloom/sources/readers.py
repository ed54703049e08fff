"""Readers: instruction tables, evaluation sets, samples, result files and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom import schemas
from gradeloom.session import written

# Result file names are <key>_benchmark.json and <key>_eval.json.
RESULT_NAME = r"([^/]+)_(benchmark|eval)\.json"

DEFAULT_PROMPTS = (
    "Describe what a database index is.",
    "Write a function that reverses a list.",
    "Name three uses of a compass.",
    "Why do leaves change colour in autumn?",
    "Summarise how a bill becomes a law.",
)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on any file system Spark can read."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def read_instructions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The instruction table; ``fmt`` is parquet or json (one object per line)."""
    reader = spark.read.schema(schemas.INSTRUCT)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def read_lines(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """``value`` and ``position`` (``with_file``: and ``file``) of every line that is not blank, over all files in the order of their paths.

    A position counts the lines before, blank ones too, and is the same however the files are
    split for reading: lines are numbered within their split as they are read, and the
    splits' line counts, one row per split, give where each begins.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"),
    )
    pieces = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("lines"), F.min("n").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")
    begins = pieces.select("file", "start", offset.alias("offset"))
    numbered = lines.where("trim(value) <> ''").join(begins, ["file", "start"])
    kept = ("value", "file") if with_file else ("value",)
    return numbered.select(*kept, (F.col("n") + F.col("offset")).alias("position"))


def read_eval_set(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """Evaluation rows, one JSON object per line; a row without an ``id`` gets its position as one.

    ``with_position`` adds the position, see ``read_lines``. A line that is not a record
    raises an error.
    """
    record = F.from_json("value", schemas.EVAL, {"mode": "FAILFAST"}).alias("record")
    rows = read_lines(spark, path).select("position", record).select("position", "record.*")
    rows = rows.withColumn("id", F.coalesce("id", "position"))
    return rows if with_position else rows.drop("position")


def read_samples(spark: SparkSession, path: str, fmt: str = "array") -> DataFrame:
    """Stored samples, in ``<source>_samples.json`` files or folders of files.

    Of both layouts: an answer is called ``generated`` or ``prediction``; the result has it
    as ``generated``. Columns that a file lacks are null.
    """
    source = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)_samples\.json", 1)
    rows = _json(spark, schemas.SAMPLES, fmt).json(path).select("*", source.alias("source"))
    return rows.withColumn("generated", F.coalesce("generated", "prediction")).drop("prediction")


def read_benchmark_records(spark: SparkSession, path: str, fmt: str = "lines") -> DataFrame:
    """Full benchmark records, one per line or per file."""
    return _json(spark, schemas.BENCH_RECORD, fmt).json(path)


def _json(spark: SparkSession, schema: str, fmt: str) -> DataFrameReader:
    """A strict reader of ``lines`` (an object per line) or an ``array`` (one array or object per file)."""
    if fmt not in ("lines", "array"):
        raise ValueError(f"fmt is lines or array, not {fmt!r}")
    return spark.read.schema(schema).option("multiLine", fmt == "array").option("mode", "FAILFAST")


def read_annotations(spark: SparkSession, path: str, systems: Sequence[str] = (), fmt: str = "array") -> DataFrame:
    """Rated samples, flat, or with one rating struct for each of ``systems``; missing notes are empty.

    ``path`` is a file or a folder; ``fmt`` is ``array`` or ``lines``. What cannot be
    read as that raises an error.
    """
    df = _json(spark, schemas.nested_ratings(tuple(systems)) if systems else schemas.ANNOTATION, fmt).json(path)
    return df if systems else df.fillna("", ["notes"])


def read_with_errors(spark: SparkSession, path: str, schema: str, fmt: str = "lines", quarantine: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of JSON files that others write, and what could not be read as one.

    ``fmt`` is ``lines`` (a record per line) or ``array`` (files that hold an array of records,
    or one record). The first result has the columns of ``schema`` and those of where a record
    stood: ``_file``, ``_place``. The second has these with ``raw`` and ``reason``: ``malformed``,
    or ``wrong type`` where a value does not fit its column. Both come from one reading, which
    is written; ``quarantine`` is a folder that receives the second one as JSON lines.
    """
    if fmt not in ("lines", "array"):
        raise ValueError(f"fmt is lines or array, not {fmt!r}")
    at = F.col("_metadata.file_path").alias("_file")
    if fmt == "lines":
        raws = read_lines(spark, path, with_file=True).select(F.col("file").alias("_file"), F.col("position").alias("_place"), F.col("value").alias("raw"))
    else:
        whole = spark.read.text(path, wholetext=True).select(at, "value")
        single = F.col("value").rlike(r"\A\s*\{")
        items = F.when(single, F.array("value")).otherwise(F.from_json("value", "ARRAY<STRING>"))
        # a file that holds neither is one broken entry
        items = F.when(items.isNull(), F.array("value")).otherwise(items)
        raws = whole.select("_file", F.posexplode(items).alias("_place", "raw")).withColumn("_place", F.col("_place").cast("long"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = raws.withColumn("_record", F.from_json("raw", f"{schema}, _corrupt STRING", options))
    parsed = parsed.withColumn(
        "reason",
        F.when(F.get_json_object("raw", "$").isNull() | ~F.col("raw").rlike(r"\A\s*\{"), "malformed")
        .when(F.col("_record").isNull() | F.col("_record._corrupt").isNotNull(), "wrong type"),
    )
    parsed = written(parsed, "parsed")
    good = parsed.where("reason IS NULL").select("_record.*", "_file", "_place").drop("_corrupt")
    bad = parsed.where("reason IS NOT NULL").select("_file", "_place", "raw", "reason")
    if quarantine is not None:
        bad.write.mode("append").json(quarantine)
    return good, bad


def collect_results(spark: SparkSession, folder: str, kind: str, fmt: str = "array") -> DataFrame:
    """All result files of one kind below a folder, keyed by name.

    ``kind`` is ``benchmark`` or ``eval``. An entry is a file, or a folder of files,
    each file holding one record or an array of records; ``fmt`` is ``lines`` where they
    hold a record per line. A missing entry is a missing row; with none at all the result
    is empty; a broken file raises an error.
    """
    schema = {"benchmark": schemas.BENCH_FILE, "eval": schemas.EVAL_FILE}[kind]
    pattern = f"{folder.rstrip('/')}/*_{kind}.json"
    name = F.regexp_extract(F.col("_metadata.file_path"), RESULT_NAME, 1)
    if not _exists(spark, pattern):
        return spark.createDataFrame([], schema).withColumn("name", F.lit(None).cast("string"))
    return (
        _json(spark, schema, fmt).json(pattern)
        .select("*", name.alias("name"))
    )


def benchmark_rows(results: DataFrame) -> DataFrame:
    """Flat benchmark figures with the chart defaults for missing values."""
    doubles = ("avg_latency_s", "std_latency_s", "avg_throughput_tokens_per_s", "std_throughput", "peak_memory_gb")
    return results.select(
        F.coalesce("framework", "name").alias("framework"),
        *[F.coalesce(F.col(f"results.{c}"), F.lit(0.0)).alias(c) for c in doubles],
        F.col("config.num_prompts").alias("num_prompts"),
        F.col("config.num_trials").alias("num_trials"),
        F.col("config.max_new_tokens").alias("max_new_tokens"),
    )


def evaluation_rows(results: DataFrame) -> DataFrame:
    """Flat evaluation figures; the model's name may sit in either of two keys."""
    return results.select("name", F.coalesce("model_name", "model").alias("model"), "num_samples", "metrics.*")


def training_rows(spark: SparkSession, root: str) -> DataFrame:
    """Statistics files of all runs below ``root``/<framework>/<run id>."""
    path = F.col("_metadata.file_path")
    return (
        _json(spark, schemas.TRAIN_STATS, "array")
        .json(f"{root.rstrip('/')}/*/*/training_stats.json")
        .withColumn("run_id", F.regexp_extract(path, r"([^/]+)/training_stats\.json$", 1))
        .withColumn("framework_dir", F.regexp_extract(path, r"([^/]+)/[^/]+/training_stats\.json$", 1))
    )


def run_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per run folder with what it holds, from a listing of its files."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    )
    part = lambda n: F.regexp_extract("path", r"/([^/]+)/(\d{8}_\d{6})/([^/]+)", n)
    return (
        files.select(part(1).alias("framework"), part(2).alias("run_id"), part(3).alias("entry"))
        .where("run_id <> ''")
        .groupBy("framework", "run_id")
        .agg(
            F.bool_or(F.col("entry") == "merged_model").alias("has_merged"),
            F.bool_or(F.col("entry") == "adapter").alias("has_adapter"),
            F.bool_or(F.col("entry") == "training_stats.json").alias("has_stats"),
        )
    )


def latest_result_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Path of the most recently modified file that matches; ties go to the later name."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def scorable_models(evals: DataFrame, samples: DataFrame) -> DataFrame:
    """Evaluation results whose model also has stored samples."""
    return evals.join(samples.select(F.col("source").alias("name")).distinct(), "name", "left_semi")


def read_splits(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    """The saved split table; one split reads only that split's folder."""
    df = spark.read.parquet(root)
    return df if split is None else df.where(F.col("split") == split)


def read_prompts(
    spark: SparkSession, path: str | None, n: int, fallback: Sequence[str] = DEFAULT_PROMPTS
) -> DataFrame:
    """First ``n`` prompts of an evaluation set, in the order of its lines, or the fallback list cycled to ``n``."""
    if path and _exists(spark, path):
        return read_eval_set(spark, path, with_position=True).orderBy("position").limit(n).select("id", "prompt")
    texts = F.array(*[F.lit(text) for text in fallback])
    return spark.range(n).withColumn("prompt", F.element_at(texts, (F.col("id") % len(fallback) + 1).cast("int")))
