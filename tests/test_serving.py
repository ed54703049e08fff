import datetime
import json
import os
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.operators import compare, generate, ratings, requests, runs
from gradeloom.operators.percentiles import percentiles
from gradeloom.session import shared_folder
from gradeloom.sources import readers, writers
from gradeloom.streaming import jobs

REQUEST = "framework STRING, request_id BIGINT, ts TIMESTAMP, latency_s DOUBLE, tokens_generated INT, memory_used_gb DOUBLE"
START = datetime.datetime(2024, 1, 1)


def _log(spark, rows):
    full = [(f, i, START + datetime.timedelta(seconds=i), lat, tok, mem) for i, (f, lat, tok, mem) in enumerate(rows)]
    return spark.createDataFrame(full, REQUEST)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(4)
    rows = [("hot", rng.choice([0.5, 0.5, rng.uniform(0, 90)]), rng.randrange(0, 50), 2.0) for _ in range(300)]
    rows += [("cold", rng.uniform(0, 3), rng.randrange(1, 50), None) for _ in range(7)]
    rows += [("single", 1.25, 10, 1.0), ("stuck", 60.0, 0, 1.0), ("stuck", 75.0, 0, 1.0), ("zero", 0.0, 5, 1.0)]
    return _log(spark, rows)


def _groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.framework, []).append(r)
    return out


def test_percentiles_equal_numpy(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 5) for _ in range(500)] + [3.0] * 400 + [-3.0, 0.0, 1e-9, 1e9]
    df = spark.createDataFrame([(k, v) for k in ("x", "y") for v in values] + [("x", None), ("one", 7.0)], "k STRING, v DOUBLE")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = {(r.k, r.p): r.percentile for r in percentiles(df, ["k"], "v", wanted).collect()}
    for p in wanted:
        assert found[("x", p)] == found[("y", p)] == pytest.approx(np.percentile(values, p * 100), rel=1e-12)
        assert found[("one", p)] == 7.0


def test_percentiles_of_odd_values_and_null_groups(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("n", v) for v in (1.0, 2.0, 3.0, nan)] + [("i", v) for v in (-inf, 1.0, inf)] + [(None, v) for v in (4.0, 6.0)]
    rows += [("t", 1.7e9 + i) for i in range(101)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    found = {(r.k, r.p): r.percentile for r in percentiles(df, ["k"], "v", [0.0, 0.5, 1.0]).collect()}
    assert found["n", 0.5] == 2.5 and np.isnan(found["n", 1.0])
    assert [found["i", p] for p in (0.0, 0.5, 1.0)] == [-inf, 1.0, inf]
    assert found[None, 0.5] == 5.0 and found["t", 0.5] == 1.7e9 + 50


def test_missing_answers_become_errors(spark):
    df = spark.range(10).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    short = lambda **options: lambda prompts: ["a"] * (len(prompts) - 1) if len(prompts) > 1 else [None if prompts[0] == "p3" else "a"]
    rows = generate.batch_generate(df, short).collect()
    assert {r.id for r in rows if r.status == "error"} == {3} and len(rows) == 10


def test_records_survive_a_round_trip(spark, tmp_path):
    card = spark.createDataFrame([("m", 7, 1.0, 2.0, 3.0, 4.0, 0.5)], "model STRING, num_samples INT, bleu_1 DOUBLE, bleu_2 DOUBLE, bleu_3 DOUBLE, bleu_4 DOUBLE, rouge_l DOUBLE")
    writers.save_records(writers.evaluation_record(card), f"{tmp_path}/m_eval.json")
    row = readers.evaluation_rows(readers.collect_results(spark, str(tmp_path), "eval", "lines")).first()
    assert (row.model, row.num_samples, row.bleu, row.bleu_1, row.bleu_3, row.bleu_4, row.rouge_l) == ("m", 7, 4.0, 1.0, 3.0, 4.0, 0.5)


def test_annotation_formats(spark, tmp_path):
    rows = [{"id": i, "prompt": "p", "helpfulness": 3} for i in range(5)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "a.json").write_text(json.dumps(rows, indent=1))
    for path, fmt in (("lines.json", "lines"), ("folder", "array")):
        assert sorted(r.id for r in readers.read_annotations(spark, f"{tmp_path}/{path}", fmt=fmt).collect()) == list(range(5))
    (tmp_path / "folder" / "b.json").write_text("{broken")
    with pytest.raises(Exception):
        readers.read_annotations(spark, f"{tmp_path}/folder").collect()


def test_summary(log):
    found = {r.framework: r for r in requests.benchmark_summary(log).collect()}
    for name, rows in _groups(log).items():
        latencies = [r.latency_s for r in rows]
        row = found[name]
        assert row.num_requests == len(rows) and row.avg_latency_s == pytest.approx(np.mean(latencies))
        assert row.p90_latency_s == pytest.approx(np.percentile(latencies, 90))
        rates = [r.tokens_generated / r.latency_s if r.latency_s > 0 else 0 for r in rows]
        assert row.avg_throughput == pytest.approx(np.mean(rates))
    assert found["cold"].peak_memory_gb == 0 and found["zero"].avg_throughput == 0
    sketch = requests.benchmark_summary(log, exact=False)
    assert set(sketch.columns) == set(requests.benchmark_summary(log).columns)


def test_timeouts_and_deviation(log):
    found = {r.framework: r for r in requests.timeout_summary(log).collect()}
    assert "stuck" not in found and found["single"].std_latency_s == 0
    answered = [r.latency_s for r in _groups(log)["hot"] if r.latency_s < 60]
    assert found["hot"].avg_latency_s == pytest.approx(statistics.mean(answered))
    assert found["hot"].std_latency_s == pytest.approx(statistics.stdev(answered))
    spread = {r.framework: r.std_latency_s for r in requests.mean_std_summary(log).collect()}
    assert spread["single"] == 0


def test_warmup(log):
    kept = _groups(requests.drop_warmup(log, 3))
    for name, rows in _groups(log).items():
        expected = sorted(r.request_id for r in rows)[3:]
        assert sorted(r.request_id for r in kept.get(name, [])) == expected


def test_early_stop(spark, monkeypatch):
    rng = random.Random(6)
    logs = {1: [5, 4, 4.5, 4.2, 4.1, 1], 2: [3, 2, 1], 3: [1, 1, 1, 1], 4: [rng.random() for _ in range(90)]}
    rows = [(run, step, float(loss)) for run, losses in logs.items() for step, loss in enumerate(losses, 1)]
    df = spark.createDataFrame(rows, "run BIGINT, step BIGINT, eval_loss DOUBLE")

    def plain(losses):
        best, bad, stop = None, 0, None
        for step, loss in enumerate(losses, 1):
            if best is None or loss < best:
                best, bad = loss, 0
            else:
                bad += 1
                if bad >= 3:
                    stop = step
                    break
        kept = losses[: stop or len(losses)]
        return stop, kept.index(min(kept)) + 1, min(kept)

    for chunk in (65536, 4):
        monkeypatch.setattr(runs, "CHUNK_STEPS", chunk)
        found = {r.run: (r.stop_step, r.best_step, r.best_loss) for r in runs.early_stop(df).collect()}
        assert found == {run: plain(losses) for run, losses in logs.items()}


def test_runs(spark):
    rows = [
        ("t", "20250101_000000", True, True, True), ("t", "20250102_000000", False, True, False),
        ("t", "20250103_000000", False, False, False), ("u", "20250101_000000", False, False, True),
    ]
    df = spark.createDataFrame(rows, "framework STRING, run_id STRING, has_merged BOOLEAN, has_adapter BOOLEAN, has_stats BOOLEAN")
    assert [(r.framework, r.path) for r in runs.latest_model(df).collect()] == [("t", "outputs/t/20250102_000000/adapter")]
    assert [r.framework for r in runs.latest_stats(df).collect()] == ["u"]


def test_comparisons(spark):
    wide = spark.createDataFrame(
        [("one", 86.57, 1.0, 0.0), ("two", 142.01, 1.0, 3.0), ("three", 329.24, 1.0, 1.0), ("four", 224.00, 1.0, 2.0)],
        "framework STRING, avg_throughput DOUBLE, avg_latency_s DOUBLE, peak_memory_gb DOUBLE",
    )
    gains = {r.framework: round(r.speedup, 2) for r in compare.speedup(wide, "one").collect()}
    assert gains == {"one": 1.0, "two": 1.64, "three": 3.8, "four": 2.59}
    radar = {r.framework: r for r in compare.radar_scores(wide, {"one": 0.7}).collect()}
    assert {r.speed for r in radar.values()} == {0.5} and radar["three"].throughput == 1 and radar["two"].setup_ease is None
    # missing memory (0) counts as the fallback of 2, so it ties with the 2 of another
    assert radar["one"].memory_efficiency == radar["four"].memory_efficiency == 0.5
    long = compare.unpivot(wide, "framework", ["avg_latency_s", "avg_throughput"])
    best = {r.metric: r.framework for r in compare.best_per_metric(long, "framework", ["avg_latency_s"], ["two", "one"]).collect()}
    assert best == {"avg_latency_s": "two", "avg_throughput": "three"}
    labelled = {r.framework: r.label for r in compare.with_labels(wide, {"one": "First"}).collect()}
    assert labelled["one"] == "First" and labelled["two"] == "two"


def test_before_after_published(spark):
    rows = [("base", 4.316440330796739, 0.16940753066561634, 0.8514308929443359),
            ("t", 5.2255788002117205, 0.1947185134472478, 0.8209097981452942),
            ("u", 6.586218629956138, 0.23613036074886795, 0.8315508365631104)]
    wide = spark.createDataFrame(rows, "model STRING, bleu DOUBLE, rouge_l DOUBLE, bertscore_f1 DOUBLE")
    found = {(r.model, r.metric): r for r in compare.before_after(wide, "base", ["bleu", "rouge_l", "bertscore_f1"]).collect()}
    assert round(found[("t", "bleu")].improvement_percent) == 21 and int(found[("u", "bleu")].improvement_percent) == 52
    assert round(found[("t", "rouge_l")].improvement_percent) == 15 and found[("u", "bertscore_f1")].improvement_percent is None


def test_ratings(spark):
    scores = {"a": ([2, 0, 4], [3, 3, 0], [0, 0, 0])}
    rows = [(i, "a", c, v) for c, values in zip(ratings.CRITERIA, scores["a"]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sample_id BIGINT, system STRING, criterion STRING, score INT")
    row = ratings.human_scores(df).first()
    assert (row.helpfulness, row.factuality, row.instruction_following, row.average) == (3.0, 3.0, None, 3.0)
    raw = ratings.human_scores(df, zero_is_missing=False).first()
    assert (raw.helpfulness, raw.factuality, raw.instruction_following) == (2.0, 2.0, 0.0)


def test_published_ratings(spark):
    path = os.environ.get("GRADELOOM_PUBLISHED_RATINGS", "")
    if not os.path.exists(path):
        pytest.skip("GRADELOOM_PUBLISHED_RATINGS names no file")
    with open(path) as f:
        systems = tuple(k.removeprefix("eval_") for k in json.load(f)[0] if k.startswith("eval_"))
    long = ratings.ratings_long(readers.read_annotations(spark, path, systems), systems)
    found = sorted((r.helpfulness, r.factuality, r.instruction_following, r.average) for r in ratings.human_scores(long).collect())
    assert found[0] == pytest.approx((2.8, 2.4, 3.4, 2.8666666666666667))
    assert found[1] == pytest.approx((2.8, 2.6, 3.4, 2.9333333333333336))


def test_nested_ratings(spark, tmp_path):
    rate = lambda *v: dict(zip(ratings.CRITERIA, v))
    rows = [{"id": i, "prompt": "p", "eval_x": rate(i, 4, 0), "eval_y": rate(5, 0, i)} for i in (1, 3)]
    (tmp_path / "rated.json").write_text(json.dumps(rows, indent=1))
    rated = readers.read_annotations(spark, f"{tmp_path}/rated.json", ("x", "y"))
    found = {r.system: (r.helpfulness, r.factuality, r.instruction_following, r.average)
             for r in ratings.human_scores(ratings.ratings_long(rated, ("x", "y"))).collect()}
    assert found == {"x": (2.0, 4.0, None, 3.0), "y": (5.0, None, 2.0, 3.5)}


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1.0, 5.0), ("b", 2.0, 6.0)], "model STRING, x DOUBLE, y DOUBLE")
    new = spark.createDataFrame([("b", 9.0, 1.0), ("c", 8.0, None)], "model STRING, x DOUBLE, z DOUBLE")
    found = {r.model: (r.x, r.y, r.z) for r in compare.upsert_metrics(old, new, ["model"]).collect()}
    assert found == {"a": (1.0, 5.0, None), "b": (9.0, 6.0, 1.0), "c": (8.0, None, None)}


def test_generation(spark):
    df = spark.range(300).select("id", F.concat(F.lit("say "), F.col("id").cast("string")).alias("prompt"))
    rows = {r.id: r for r in generate.batch_generate(df, "ECHO", max_new_tokens=1).collect()}
    assert len(rows) == 300 and rows[7].text == "7" and rows[7].tokens_generated == 1 and rows[7].latency_s >= 0
    with pytest.raises(ValueError):
        generate.batch_generate(df, "nobody")

    def flaky(**options):
        def answer(prompts):
            if any(p.endswith("13") for p in prompts):
                raise RuntimeError("unlucky")
            return ["fine"] * len(prompts)
        return answer

    generate.register_engine("Flaky", flaky)
    rows = generate.batch_generate(df, "flaky").collect()
    failed = {r.id for r in rows if r.status == "error"}
    assert failed == {13, 113, 213} and all(r.text == "fine" for r in rows if r.id not in failed)


def test_files(spark, tmp_path):
    root = str(tmp_path)
    for name, record in {
        "a": {"framework": "a", "config": {"num_prompts": 5}, "results": {"avg_latency_s": 1.5}},
        "b": {"framework": "b", "results": {"avg_latency_s": 2.5, "peak_memory_gb": 3}},
    }.items():
        (tmp_path / f"{name}_benchmark.json").write_text(json.dumps(record, indent=2))
    (tmp_path / "a_eval.json").write_text(json.dumps({"model": "A", "num_samples": 3, "metrics": {"bleu": 4.0}}))
    (tmp_path / "a_samples.json").write_text(json.dumps([{"prompt": "p", "reference": "r", "generated": "g"}] * 2))
    bench = {r.framework: r for r in readers.benchmark_rows(readers.collect_results(spark, root, "benchmark")).collect()}
    assert bench["a"].avg_latency_s == 1.5 and bench["a"].peak_memory_gb == 0 and bench["b"].peak_memory_gb == 3
    evals = readers.evaluation_rows(readers.collect_results(spark, root, "eval"))
    assert [(r.name, r.model, r.bleu) for r in evals.collect()] == [("a", "A", 4.0)]
    samples = readers.read_samples(spark, f"{root}/*_samples.json")
    assert samples.count() == 2 and readers.scorable_models(evals, samples).count() == 1
    assert readers.collect_results(spark, f"{root}/none", "eval").count() == 0
    assert readers.read_prompts(spark, f"{root}/missing.json", 7).count() == 7
    assert readers.latest_result_file(spark, f"{root}/*_benchmark.json").first().path.endswith("_benchmark.json")


def test_run_folders(spark, tmp_path):
    for run, files in {"20250101_000000": ["merged_model/w.bin", "training_stats.json"], "20250102_000000": ["adapter/a.bin"]}.items():
        for name in files:
            path = tmp_path / "t" / run / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text('{"framework": "t", "train_loss": 1.5}')
    manifest = readers.run_manifest(spark, str(tmp_path))
    assert {(r.run_id, r.has_merged, r.has_adapter, r.has_stats) for r in manifest.collect()} == {
        ("20250101_000000", True, False, True), ("20250102_000000", False, True, False)}
    assert [(r.run_id, r.train_loss) for r in readers.training_rows(spark, str(tmp_path)).collect()] == [("20250101_000000", 1.5)]


def test_writers(spark, tmp_path, log):
    root = str(tmp_path)
    card = spark.createDataFrame([("m", 3, 0.5)], "model STRING, num_samples BIGINT, bleu_4 DOUBLE")
    writers.save_records(writers.evaluation_record(card), f"{root}/m_eval.json", one_per_file=True)
    assert spark.read.json(f"{root}/m_eval.json").first().metrics.bleu_4 == 0.5
    writers.save_comparison(requests.display_table(requests.benchmark_summary(log)), f"{root}/table")
    back = spark.read.option("header", True).csv(f"{root}/table")
    assert back.count() == 5 and "p90_latency_s" in back.columns
    stats = spark.createDataFrame([("t", 1.0)], "framework STRING, train_loss DOUBLE")
    writers.append_training_stats(stats, f"{root}/stats")
    writers.append_training_stats(stats, f"{root}/stats")
    assert spark.read.json(f"{root}/stats").count() == 2
    split = spark.createDataFrame([(1, "train"), (2, "test")], "id BIGINT, split STRING")
    writers.save_splits(split, f"{root}/splits", f"{root}/splits-json")
    train = readers.read_splits(spark, f"{root}/splits", "train")
    assert [r.id for r in train.collect()] == [1] and "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().toString()


def test_shared_folder_follows_the_session(spark):
    class Session:
        def __init__(self, folder, master):
            known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://tables"}
            self.conf = type("Conf", (), {"get": lambda _, key, default=None: known.get(key) or default})()
            self.sparkContext = type("Context", (), {"master": master})()

    assert shared_folder(Session("hdfs://shared/", "yarn"), "x").startswith("hdfs://shared/x-")
    # the warehouse is shared as well; a machine-local folder is never taken
    assert shared_folder(Session(None, "yarn"), "x").startswith("hdfs://tables/_work/x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_late_requests_drop_out(spark, tmp_path):
    def batch(name, hours):
        rows = [("f", i, START + datetime.timedelta(hours=h), 1.0, 10, None) for i, h in enumerate(hours)]
        spark.createDataFrame(rows, REQUEST).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    # the third file is older than the watermark that the second one sets
    landing = f"{tmp_path}/in"
    batch("in", [1, 2])
    query = None
    stream = jobs.request_windows(jobs.file_stream(spark, landing, REQUEST), "1 hour", "1 hour", percentiles=True)

    def step():
        nonlocal query
        query = (
            stream.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
        )
        query.awaitTermination()

    step()
    batch("in", [30])
    step()
    batch("in", [2])
    step()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.num_requests for r in rows) == [1, 1]
    assert {r.p50_latency_s for r in rows} == {1.0}
