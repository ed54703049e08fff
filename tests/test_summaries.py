"""One-pass summaries, stored sketches, rating levels, step numbers, logs that differ, broken files."""

import json
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.operators import prefix, profile, ratings, requests, rollups, runs
from gradeloom.sources import readers, versions


def test_describe_matches_plain_figures(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(9)), rng.gauss(0, 1e3), None, 7.5 if i == 0 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {r["metric"]: r for r in profile.describe(df, ("a", "b", "c", "d")).collect()}
    for k, name in enumerate("abd"):
        values = [r["abd".index(name) + (name == "d")] for r in rows]
        values = [v for v in values if v is not None]
        r = got[name]
        expected = [len(values), statistics.fmean(values), min(values), max(values), *np.percentile(values, [25, 50, 75])]
        assert [r["count"], r["mean"], r["min"], r["max"], r["p25"], r["p50"], r["p75"]] == pytest.approx(expected)
        assert r["std"] == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)
    assert got["c"]["count"] == 0 and got["c"]["mean"] is None and got["c"]["p50"] is None
    assert profile.describe(df.limit(0), ("a",)).count() == 0


def test_describe_with_values_that_are_no_numbers(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, math.nan, math.inf, -math.inf, None)], "a double")
    [r] = profile.describe(df, ("a",)).collect()
    assert r["count"] == 4 and r["min"] == -math.inf and math.isnan(r["max"]) and math.isnan(r["mean"])


@pytest.mark.parametrize("summary", [profile.describe, profile.histogram])
def test_texts_are_read_once(spark, sf_dir, summary):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("size", F.length("text"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = summary(docs, ("size",))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs  # planning runs nothing
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1, plan


def plain_steps(rows):
    out, n = {}, {}
    for run, ts, tie in sorted(rows):
        n[run] = n.get(run, 0) + 1
        out[(run, tie)] = n[run]
    return out


@pytest.mark.parametrize("most", [10, 1000])
def test_steps_of_crowded_hours(spark, most):
    rng = random.Random(most)
    rows = [(1, f"2024-01-01 10:00:00.{rng.randrange(4):06d}", i) for i in range(300)]  # all in one second
    rows += [(2, f"2024-01-01 10:{rng.randrange(60):02d}:{rng.randrange(60):02d}", i) for i in range(300)]  # one hour
    rows += [(3, f"2024-01-{1 + i % 20:02d} {i % 24:02d}:00:00", i) for i in range(200)]
    rows += [(4, "2024-01-01 00:00:00", 5)]
    log = spark.createDataFrame(rows, "run long, at string, tie long").withColumn("ts", F.to_timestamp("at"))
    got = {(r["run"], r["tie"]): r["step"] for r in runs.number_steps(log, "run", "ts", "tie", most).collect()}
    assert got == plain_steps(rows)
    sizes = runs.step_chunks(log, "run", "ts", "tie", most).groupBy("run", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= most


REQUESTS = "framework string, request_id long, ts timestamp, latency_s double, tokens_generated int, memory_used_gb double"


def test_rollups_of_parts_are_those_of_the_whole(spark, tmp_path):
    log = spark.range(40_000).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("framework"),
        F.col("id").alias("request_id"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
        (F.pow(F.pmod(F.xxhash64("id"), F.lit(10_007)), F.lit(1.5)) / 100).alias("latency_s"),
        (F.col("id") % 90).cast("int").alias("tokens_generated"),
        F.when(F.col("id") % 3 != 1, F.col("id") % 11).cast("double").alias("memory_used_gb"),
    )
    root = f"{tmp_path}/rollup"
    for k in range(3):
        assert rollups.add_requests(log.where(F.pmod("request_id", F.lit(3)) == k), root) == k + 1
    found = rollups.summary(versions.read_version(spark, root))
    exact = {r["framework"]: r for r in requests.benchmark_summary(log).collect()}
    for r in found.collect():
        for name in ("num_requests", "avg_latency_s", "min_latency_s", "max_latency_s", "avg_throughput", "total_tokens", "peak_memory_gb", "avg_memory_gb"):
            assert r[name] == pytest.approx(exact[r["framework"]][name]), name
    worst = rollups.rank_errors(found, log).collect()
    assert len(worst) == 3
    assert all(r[f"{p}_rank_error"] <= rollups.RANK_ERROR for r in worst for p in ("p50", "p90", "p99"))
    part = rollups.summary(versions.read_version(spark, root), begin="1970-01-01 01:00:00", end="1970-01-01 03:00:00")
    assert part.agg(F.sum("num_requests")).first()[0] == log.where("ts >= '1970-01-01 01:00:00' and ts < '1970-01-01 03:00:00'").count()
    # sketches stay small, whatever they have seen
    assert versions.read_version(spark, root).agg(F.max(F.octet_length("latencies"))).first()[0] < 64 * rollups.SKETCH_K


def test_levels_of_ratings(spark):
    rows = [(1, "a", "x", 5), (2, "a", "x", 0), (1, "a", "y", 3), (1, "b", "x", 0), (1, None, "y", 4)]
    df = spark.createDataFrame(rows, "sample_id long, system string, criterion string, score int")
    got = {(r["level"], r["system"], r["criterion"]): (r["mean"], r["rated"], r["entries"]) for r in ratings.score_levels(df).collect()}
    assert got == {
        ("both", "a", "x"): (5.0, 1, 2), ("both", "a", "y"): (3.0, 1, 1), ("both", "b", "x"): (None, 0, 1), ("both", None, "y"): (4.0, 1, 1),
        ("system", "a", None): (4.0, 2, 3), ("system", "b", None): (None, 0, 1), ("system", None, None): (4.0, 1, 1),
        ("criterion", None, "x"): (5.0, 1, 3), ("criterion", None, "y"): (3.5, 2, 2), ("all", None, None): (4.0, 3, 5),
    }


def test_logs_that_differ(spark):
    one = spark.createDataFrame([("a", 1, 2)], "name string, n int, only int")
    two = spark.createDataFrame([("b", 2.5, None), (None, None, "t")], "name string, n double, extra string")
    three = spark.createDataFrame([(7, 1 << 40)], "name long, n long")
    df = requests.append_logs(one, two, three)
    assert df.dtypes == [("name", "string"), ("n", "double"), ("only", "int"), ("extra", "string")]
    assert sorted(map(str, df.collect())) == sorted(
        map(str, spark.createDataFrame([("a", 1.0, 2, None), ("b", 2.5, None, None), (None, None, None, "t"), ("7", float(1 << 40), None, None)], df.schema).collect())
    )
    assert requests.append_logs(one.select(F.lit(None).alias("v")), one.select(F.lit(3).alias("v"))).dtypes == [("v", "int")]
    assert requests.agreed_type(["float", "bigint"]) == "double" and requests.agreed_type(["boolean", "int"]) == "string"


def test_broken_files_are_set_aside(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "v": 2.5}\n\n{"id": 2, "v": \n{"id": "x", "v": 1}\nnot json\n[1]\n{"id": 3}\n')
    (folder / "b.json").write_text('{"id": 4, "v": 1, "more": true}')
    aside = f"{tmp_path}/aside"
    good, bad = readers.read_with_errors(spark, str(folder), "id BIGINT, v DOUBLE", quarantine=aside)
    assert sorted((r["id"], r["v"], r["_place"]) for r in good.select("id", F.coalesce("v", F.lit(-1.0)).alias("v"), "_place").collect()) == [
        (1, 2.5, 0), (3, -1.0, 6), (4, 1.0, 7)
    ]
    expected = [(2, "malformed"), (3, "wrong type"), (4, "malformed"), (5, "malformed")]
    assert sorted((r["_place"], r["reason"]) for r in bad.collect()) == expected
    kept = spark.read.json(aside)
    assert sorted(r["raw"] for r in kept.collect()) == sorted(['{"id": 2, "v": ', '{"id": "x", "v": 1}', "not json", "[1]"])

    arrays = tmp_path / "arrays"
    arrays.mkdir()
    (arrays / "a.json").write_text(json.dumps([{"id": 1, "v": 1}, {"id": "y"}, {"id": 2}], indent=1))
    (arrays / "b.json").write_text(json.dumps({"id": 3, "v": 0.5}, indent=1))
    (arrays / "c.json").write_text('[{"id": 4},')
    good, bad = readers.read_with_errors(spark, str(arrays), "id BIGINT, v DOUBLE", "array")
    assert sorted(r["id"] for r in good.collect()) == [1, 2, 3]
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "wrong type"]
    with pytest.raises(ValueError, match="lines or array"):
        readers.read_with_errors(spark, str(arrays), "id BIGINT", "csv")


def test_running_takes_chunks_of_any_type(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 7), (1, 2, 1)], "k long, c long, v long").withColumn("chunk", F.struct("c"))
    got = prefix.running(df, ["k"], "chunk", ["c", "v"], "v", "sum", "upto").select("v", "upto").collect()
    assert sorted(map(tuple, got)) == [(1, 6), (5, 5), (7, 13)]
