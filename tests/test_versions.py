"""Versioned tables, streams that report open windows, and positions of lines."""

import json
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from gradeloom.plans import workflows
from gradeloom.sources import readers, versions
from gradeloom.streaming import jobs


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions_follow_each_other(spark, tmp_path):
    root = f"{tmp_path}/scores"
    assert versions.last_version(spark, root) is None
    with pytest.raises(ValueError, match="nothing is published"):
        versions.read_version(spark, root)
    first = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.25)], "model string, id long, bleu double")
    assert versions.upsert_version(first, root, ("model", "id")) == 1
    update = spark.createDataFrame([("a", 2, None, 0.75), ("b", 1, 0.1, 0.2)], "model string, id long, bleu double, rouge double")
    assert versions.upsert_version(update, root, ("model", "id")) == 2
    assert rows(versions.read_version(spark, root, 1)) == [("a", 1, 0.5), ("a", 2, 0.25)]
    last = versions.read_version(spark, root)
    assert sorted(map(str, last.select("model", "id", "bleu", "rouge").collect())) == sorted(
        map(str, spark.createDataFrame([("a", 1, 0.5, None), ("a", 2, 0.25, 0.75), ("b", 1, 0.1, 0.2)], "model string, id long, bleu double, rouge double").collect())
    )
    assert versions.publish(last.limit(0), root, 2) == 3
    assert versions.read_version(spark, root).columns == last.columns and versions.read_version(spark, root).count() == 0


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/scores"
    versions.publish(spark.range(5), root)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, root, 1)
    assert versions.last_version(spark, root) == 1
    assert versions.read_version(spark, root).count() == 5


def test_writers_after_one_version(spark, tmp_path):
    root = f"{tmp_path}/scores"
    versions.publish(spark.range(1), root)
    assert versions.publish(spark.range(2), root, 1) == 2
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark.range(3), root, 1)
    assert versions.read_version(spark, root).count() == 2
    assert not [p for p in (tmp_path / "scores" / "manifests").iterdir() if p.name.startswith("_")]
    # many at once: nothing is lost
    errors = []

    def add(k):
        try:
            versions.change(spark, root, lambda old: old.union(spark.range(100 + k, 101 + k)), attempts=20)
        except Exception as e:  # told below
            errors.append(e)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and versions.last_version(spark, root) == 6
    assert {r["id"] for r in versions.read_version(spark, root).collect()} == {0, 1, 100, 101, 102, 103}


def test_rescoring_keeps_what_is_not_scored_again(spark, tmp_path):
    root = f"{tmp_path}/scores"
    samples = spark.createDataFrame([("m", 1, "a b c d", "a b c d"), ("m", 2, "x", "y z")], "model string, id long, prediction string, reference string")
    assert workflows.rescore(samples, root, metrics=["bleu_1"]) == 1
    assert workflows.rescore(samples.where("id = 1"), root, metrics=["rouge_1"]) == 2
    found = {r["id"]: (r["bleu_1"], r["rouge_1"]) for r in versions.read_version(spark, root).collect()}
    assert found == {1: (1.0, 1.0), 2: (0.0, None)}


REQUESTS = "framework string, request_id long, ts timestamp, latency_s double, tokens_generated int, memory_used_gb double"


def test_open_windows_are_reported_and_replays_count_once(spark, tmp_path):
    landing = tmp_path / "landing"
    batches = [
        [("a", 1, "2024-01-01 10:00:00", 1.0, 5), ("a", 2, "2024-01-01 10:30:00", 3.0, 5)],
        [("a", 3, "2024-01-01 10:45:00", 5.0, 5), ("b", 4, "2024-01-01 11:10:00", 2.0, 4)],
        [("b", 5, "2024-01-01 11:20:00", 4.0, 4)],
    ]
    for k, batch in enumerate(batches):
        frame = spark.createDataFrame([(f, i, t, s, n, 1.0) for f, i, t, s, n in batch], REQUESTS.replace("ts timestamp", "ts string"))
        frame.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{tmp_path}/b{k}")
        landing.mkdir(exist_ok=True)
        [part] = (tmp_path / f"b{k}").glob("*.parquet")
        shutil.copy(part, landing / f"{k}.parquet")

    def stream():
        files = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(str(landing))
        return jobs.request_windows(files, "1 hour", "1 hour").withColumn("window_start", F.date_format("window_start", "HH"))

    expected = [("10", "a", 3, 3.0), ("11", "b", 2, 3.0)]
    key = ("window_start", "framework")
    target = f"{tmp_path}/rows"
    for progress in ("first", "again"):  # the second run replays all batches into the same folders
        query = stream().writeStream.outputMode("update").foreachBatch(jobs.version_sink(target))
        query.option("checkpointLocation", f"{tmp_path}/{progress}").trigger(availableNow=True).start().awaitTermination()
        got = jobs.newest_rows(spark, target, stream().schema, key)
        assert rows(got.select(*key, "num_requests", "avg_latency_s")) == expected
    assert spark.read.parquet(target).count() > len(expected)  # older states are there, and passed over
    assert rows(jobs.run_updates(stream(), "windows", key).select(*key, "num_requests", "avg_latency_s")) == expected


def test_positions_are_the_same_however_files_are_split(spark, tmp_path):
    folder = tmp_path / "evals"
    folder.mkdir()
    written = []
    for k, n in enumerate((300, 0, 1, 177)):
        lines = [json.dumps({"prompt": f"p{k}-{i}", "reference": "r" * (i % 90)}) for i in range(n)]
        lines[5:5] = ["", "  "] if n > 5 else []
        written += lines
        (folder / f"part-{k}.json").write_text("".join(line + "\n" for line in lines))
    expected = [(i, json.loads(line)["prompt"]) for i, line in enumerate(written) if line.strip()]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {name: spark.conf.get(name) for name in names}
    splits = set()
    try:
        for size in ("1g", "1k", "777"):
            for name in names:
                spark.conf.set(name, size)
            read = readers.read_eval_set(spark, str(folder))
            splits.add(spark.read.text(str(folder)).rdd.getNumPartitions())
            assert rows(read.select("id", "prompt")) == expected
            assert [tuple(r) for r in readers.read_prompts(spark, str(folder), 7).collect()] == expected[:7]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len(splits) == 3


def test_ids_in_the_file_stay_and_broken_lines_raise(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 40, "prompt": "x"}\n{"prompt": "y"}\n')
    assert rows(readers.read_eval_set(spark, f"{tmp_path}/a.json").select("id", "prompt")) == [(1, "y"), (40, "x")]
    (tmp_path / "b.json").write_text('{"id": 1, "prompt": "x"}\n{"prompt": \n')
    with pytest.raises(Exception):  # noqa: B017
        readers.read_eval_set(spark, f"{tmp_path}/b.json").collect()
