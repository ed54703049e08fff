"""Queries over request logs and training runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeloom.functions import units
from gradeloom.operators import compare, generate, profile, requests, rollups, runs
from gradeloom.plans import sql as S
from gradeloom.plans import tables
from gradeloom.plans.registry import query
from gradeloom.session import shared_folder
from gradeloom.sources import readers, versions, writers
from gradeloom.streaming import jobs

_SUMMARY = """SELECT framework, round(avg(latency_s), 6) AS avg_latency_s, round(min(latency_s), 6) AS min_latency_s,
  round(max(latency_s), 6) AS max_latency_s, round(avg(rate), 6) AS avg_throughput, sum(tokens_generated)::BIGINT AS total_tokens,
  coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb, round(coalesce(avg(memory_used_gb), 0), 6) AS avg_memory_gb,
  count(*) AS num_requests, round(quantile_cont(latency_s, 0.5), 6) AS p50_latency_s,
  round(quantile_cont(latency_s, 0.9), 6) AS p90_latency_s, round(quantile_cont(latency_s, 0.99), 6) AS p99_latency_s
  FROM {source} GROUP BY framework"""


@query("bench_summary", f"WITH {S.REQUESTS} {_SUMMARY.format(source='timed')}")
def bench_summary(spark, sf_dir):
    return requests.benchmark_summary(tables.requests(spark, sf_dir))


@query(
    "bench_no_warmup",
    f"""WITH {S.REQUESTS}, placed AS (SELECT *, row_number() OVER (PARTITION BY framework ORDER BY ts, request_id) AS n FROM timed)
    {_SUMMARY.format(source='(SELECT * FROM placed WHERE n > 3)')}""",
)
def bench_no_warmup(spark, sf_dir):
    return requests.benchmark_summary(requests.drop_warmup(tables.requests(spark, sf_dir)))


_RANGE = ("2024-01-05", "2024-01-20")


@query(
    "bench_rollup",
    f"""WITH {S.REQUESTS} SELECT framework, count(*) AS num_requests, round(avg(latency_s), 6) AS avg_latency_s,
    round(min(latency_s), 6) AS min_latency_s, round(max(latency_s), 6) AS max_latency_s, round(avg(rate), 6) AS avg_throughput,
    sum(tokens_generated)::BIGINT AS total_tokens, coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb,
    round(coalesce(avg(memory_used_gb), 0), 6) AS avg_memory_gb, true AS p50_within, true AS p90_within, true AS p99_within
    FROM timed WHERE ts >= '{_RANGE[0]}' AND ts < '{_RANGE[1]}' GROUP BY framework""",
)
def bench_rollup(spark, sf_dir):
    """A range of days from stored hours; late requests were merged in; quantiles within the stated rank error."""
    root, log = shared_folder(spark, "rollup"), tables.requests(spark, sf_dir)
    late = F.pmod("request_id", F.lit(7)) == 0
    rollups.add_requests(log.where(~late), root)
    rollups.add_requests(log.where(late), root)
    found = rollups.summary(versions.read_version(spark, root), begin=_RANGE[0], end=_RANGE[1])
    errors = rollups.rank_errors(found, log.where((F.col("ts") >= _RANGE[0]) & (F.col("ts") < _RANGE[1])))
    within = [(F.col(f"{p}_rank_error") <= rollups.RANK_ERROR).alias(f"{p}_within") for p in ("p50", "p90", "p99")]
    return found.join(errors, "framework").select(*[c for c in found.columns if c not in rollups.QUANTILES], *within)


@query(
    "bench_appended",
    f"""WITH {S.REQUESTS}, runs AS (SELECT *, CASE framework WHEN 'click' THEN 'fast' WHEN 'view' THEN 'wide' END AS config,
      CASE WHEN framework <> 'error' THEN request_id % 3 END AS trial,
      CASE WHEN framework = 'view' THEN NULL ELSE memory_used_gb END AS seen_gb FROM timed WHERE framework IN ('click', 'view', 'error'))
    SELECT framework, config, trial, round(avg(latency_s), 6) AS avg_latency_s, round(coalesce(stddev_samp(latency_s), 0), 6) AS std_latency_s,
    round(avg(tokens_generated), 6) AS avg_tokens_generated, round(avg(rate), 6) AS avg_throughput,
    round(coalesce(stddev_samp(rate), 0), 6) AS std_throughput, coalesce(max(seen_gb), 0)::DOUBLE AS peak_memory_gb
    FROM runs GROUP BY framework, config, trial""",
)
def bench_appended(spark, sf_dir):
    """Logs of three engine versions with different columns and types, summarised by framework, configuration and trial."""
    log = tables.requests(spark, sf_dir)
    trial = F.pmod("request_id", F.lit(3))
    click = log.where("framework = 'click'").withColumns({"config": F.lit("fast"), "trial": trial.cast("int")})
    view = log.where("framework = 'view'").drop("memory_used_gb")
    view = view.withColumns({"config": F.lit("wide"), "trial": trial, "tokens_generated": F.col("tokens_generated").cast("double")})
    error = log.where("framework = 'error'")
    return requests.mean_std_summary(requests.append_logs(error, click, view), ("framework", "config", "trial"))


@query(
    "result_errors",
    f"""WITH {S.REQUESTS}, said AS (SELECT framework, latency_s,
      CASE request_id % 10 WHEN 3 THEN 'malformed' WHEN 7 THEN 'wrong type' END AS reason FROM req)
    SELECT framework, coalesce(reason, 'read') AS outcome, count(*) AS n,
    round(sum(CASE WHEN reason IS NULL THEN latency_s END), 3) AS latency_s FROM said GROUP BY ALL""",
)
def result_errors(spark, sf_dir):
    """Result lines of which some are cut off and some hold text for a number: what was read, and what was set aside."""
    path = shared_folder(spark, "foreign-results")
    log = tables.requests(spark, sf_dir)
    line = F.to_json(F.struct("framework", "request_id", "latency_s"))
    wrong = F.to_json(F.struct("framework", F.lit("seven").alias("request_id"), "latency_s"))
    kind = F.pmod("request_id", F.lit(10))
    lines = F.when(kind == 3, F.substring(line, 1, 35)).when(kind == 7, wrong).otherwise(line)
    log.select("framework", lines.alias("value")).write.partitionBy("framework").text(path)
    good, bad = readers.read_with_errors(
        spark, f"{path}/*", "framework STRING, request_id BIGINT, latency_s DOUBLE", quarantine=shared_folder(spark, "quarantine")
    )
    of_file = F.regexp_extract("_file", "framework=([^/]+)/", 1)
    read = good.select("framework", F.lit("read").alias("outcome"), "latency_s")
    aside = bad.select(of_file.alias("framework"), F.col("reason").alias("outcome"), F.lit(None).cast("double").alias("latency_s"))
    return read.union(aside).groupBy("framework", "outcome").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("latency_s"), 3).alias("latency_s"))


@query(
    "bench_engine_summary",
    f"""WITH {S.REQUESTS} SELECT framework, count(*) AS num_requests, round(avg(latency_s), 6) AS avg_latency_s,
    round(avg(rate), 6) AS avg_throughput, coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb,
    sum(tokens_generated)::BIGINT AS total_tokens, round(sum(latency_s), 6) AS total_time_s FROM timed GROUP BY framework""",
)
def bench_engine_summary(spark, sf_dir):
    return requests.engine_summary(tables.requests(spark, sf_dir))


@query(
    "bench_mean_std",
    f"""WITH {S.REQUESTS} SELECT framework, round(avg(latency_s), 6) AS avg_latency_s,
    round(coalesce(stddev_samp(latency_s), 0), 6) AS std_latency_s, round(avg(tokens_generated), 6) AS avg_tokens_generated,
    round(avg(rate), 6) AS avg_throughput, round(coalesce(stddev_samp(rate), 0), 6) AS std_throughput,
    coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb FROM timed GROUP BY framework""",
)
def bench_mean_std(spark, sf_dir):
    return requests.mean_std_summary(tables.requests(spark, sf_dir))


@query(
    "bench_timeouts",
    f"""WITH {S.REQUESTS}, masked AS (
      SELECT framework, latency_s, CASE WHEN latency_s >= 60 THEN 0 ELSE tokens_generated END AS tok,
             CASE WHEN latency_s >= 60 THEN 0 ELSE rate END AS rate FROM timed)
    SELECT framework, round(avg(latency_s) FILTER (WHERE latency_s < 60), 6) AS avg_latency_s,
    round(coalesce(stddev_samp(latency_s) FILTER (WHERE latency_s < 60), 0), 6) AS std_latency_s,
    round(coalesce(avg(tok) FILTER (WHERE tok > 0), 0), 6) AS avg_tokens_generated,
    round(coalesce(avg(rate) FILTER (WHERE rate > 0), 0), 6) AS avg_throughput,
    round(coalesce(stddev_samp(rate) FILTER (WHERE rate > 0), 0), 6) AS std_throughput,
    count(*) FILTER (WHERE latency_s >= 60) AS timeouts, count(*) FILTER (WHERE latency_s < 60) AS answered
    FROM masked GROUP BY framework HAVING count(*) FILTER (WHERE latency_s < 60) > 0""",
)
def bench_timeouts(spark, sf_dir):
    return requests.timeout_summary(requests.mask_timeouts(tables.requests(spark, sf_dir)))


@query(
    "bench_std_from_p90",
    f"""WITH {S.REQUESTS} SELECT framework, round(avg(latency_s), 6) AS avg_latency_s,
    round(coalesce(stddev_samp(latency_s), 0), 6) AS std_latency_s,
    round((quantile_cont(latency_s, 0.9) - avg(latency_s)) / 1.28, 6) AS std_from_p90,
    round(sum(tokens_generated) / count(*)::DOUBLE, 6) AS avg_tokens_generated FROM timed GROUP BY framework""",
)
def bench_std_from_p90(spark, sf_dir):
    log = tables.requests(spark, sf_dir)
    estimated = requests.std_from_p90(requests.benchmark_summary(log))
    true = requests.mean_std_summary(log).select("framework", "std_latency_s")
    return estimated.join(true, "framework").select(
        "framework", "avg_latency_s", "std_latency_s", "std_from_p90", "avg_tokens_generated"
    )


@query(
    "bench_display",
    f"""WITH {S.REQUESTS} SELECT framework, round(avg(latency_s), 3) AS avg_latency_s,
    round(quantile_cont(latency_s, 0.9), 3) AS p90_latency_s, round(avg(rate), 1) AS avg_throughput,
    round(coalesce(max(memory_used_gb), 0)::DOUBLE, 2) AS peak_memory_gb, sum(tokens_generated)::BIGINT AS total_tokens
    FROM timed GROUP BY framework""",
)
def bench_display(spark, sf_dir):
    return requests.display_table(requests.benchmark_summary(tables.requests(spark, sf_dir)))


_MEANS = """means AS (
  SELECT framework, round(avg(latency_s), 6) AS avg_latency_s, round(avg(rate), 6) AS avg_throughput,
         coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb FROM timed GROUP BY framework
)"""
_KEY_FIGURES = ("avg_latency_s", "avg_throughput", "peak_memory_gb")


def _means(spark, sf_dir):
    summary = requests.engine_summary(tables.requests(spark, sf_dir))
    return summary.select("framework", *[F.round(c, 6).alias(c) for c in _KEY_FIGURES])


@query(
    "bench_winners",
    f"""WITH {S.REQUESTS}, {_MEANS},
    long AS (UNPIVOT means ON avg_latency_s, avg_throughput, peak_memory_gb INTO NAME metric VALUE value)
    SELECT metric, framework, value FROM (SELECT *, row_number() OVER (PARTITION BY metric
      ORDER BY CASE WHEN metric = 'avg_throughput' THEN -value ELSE value END, framework) AS n FROM long) WHERE n = 1""",
)
def bench_winners(spark, sf_dir):
    long = compare.unpivot(_means(spark, sf_dir), "framework", _KEY_FIGURES)
    return compare.best_per_metric(
        long, "framework", ("avg_latency_s", "peak_memory_gb"), tables.FRAMEWORKS
    )


@query(
    "speedup",
    f"""WITH {S.REQUESTS}, {_MEANS} SELECT framework, avg_throughput AS throughput,
    round(avg_throughput / (SELECT avg_throughput FROM means WHERE framework = 'click'), 6) AS speedup FROM means""",
)
def speedup(spark, sf_dir):
    return compare.speedup(_means(spark, sf_dir), "click")


@query(
    "radar_scores",
    f"""WITH {S.REQUESTS}, {_MEANS}, filled AS (
      SELECT framework, avg_latency_s AS l, avg_throughput AS t, CASE WHEN peak_memory_gb > 0 THEN peak_memory_gb ELSE 2 END AS m FROM means),
    spans AS (SELECT min(l) AS l0, max(l) AS l1, min(t) AS t0, max(t) AS t1, min(m) AS m0, max(m) AS m1 FROM filled)
    SELECT framework, round(CASE WHEN l1 = l0 THEN 0.5 ELSE (l1 - l) / (l1 - l0) END, 6) AS speed,
    round(CASE WHEN t1 = t0 THEN 0.5 ELSE (t - t0) / (t1 - t0) END, 6) AS throughput,
    round(CASE WHEN m1 = m0 THEN 0.5 ELSE (m1 - m) / (m1 - m0) END, 6) AS memory_efficiency,
    CASE framework {' '.join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in tables.SETUP_EASE.items())} END AS setup_ease
    FROM filled, spans""",
)
def radar_scores(spark, sf_dir):
    return compare.radar_scores(_means(spark, sf_dir), tables.SETUP_EASE)


@query(
    "summary_table",
    f"""WITH {S.REQUESTS}, {_MEANS},
    training AS (SELECT event_type AS framework, round(avg(value), 6) AS training_time_minutes FROM events
                 WHERE event_type IN ('click', 'view') GROUP BY 1),
    human AS (SELECT CASE WHEN toxic = 1 THEN 'click' ELSE 'error' END AS framework, round(avg(quality), 6) AS quality FROM labels GROUP BY 1),
    long AS (
      UNPIVOT means ON avg_latency_s, avg_throughput, peak_memory_gb INTO NAME metric VALUE value
      UNION ALL SELECT framework, 'training_time_minutes', training_time_minutes FROM training
      UNION ALL SELECT framework, 'quality', quality FROM human)
    SELECT metric, {S.pick('framework', 'value', tables.FRAMEWORKS)} FROM long GROUP BY metric""",
)
def summary_table(spark, sf_dir):
    """Benchmark, training and quality figures per framework; absent figures are null."""
    stats = runs.training_figures(tables.training_stats(spark, sf_dir)).where("framework IN ('click', 'view')")
    training = stats.groupBy("framework").agg(F.avg("training_time_minutes").alias("training_time_minutes"))
    labels = tables.table(spark, sf_dir, "labels")
    judged = labels.groupBy(F.when(F.col("toxic") == 1, "click").otherwise("error").alias("framework")).agg(
        F.avg("quality").alias("quality")
    )
    return compare.summary_table(
        [(_means(spark, sf_dir), _KEY_FIGURES), (training, ["training_time_minutes"]), (judged, ["quality"])],
        tables.FRAMEWORKS,
    )


@query(
    "collect_results",
    f"""WITH {S.REQUESTS} SELECT framework, round(avg(latency_s), 6) AS avg_latency_s,
    round(coalesce(stddev_samp(latency_s), 0), 6) AS std_latency_s, round(avg(rate), 6) AS avg_throughput_tokens_per_s,
    round(coalesce(stddev_samp(rate), 0), 6) AS std_throughput, coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb
    FROM timed GROUP BY framework""",
)
def collect_results(spark, sf_dir):
    """Benchmark records written as JSON and read back into flat figures."""
    folder = shared_folder(spark, "results")
    summary = requests.mean_std_summary(tables.requests(spark, sf_dir))
    writers.save_records(writers.benchmark_record(summary), f"{folder}/all_benchmark.json", one_per_file=True)
    collected = readers.collect_results(spark, folder, "benchmark")
    return readers.benchmark_rows(collected).drop("num_prompts", "num_trials", "max_new_tokens")


@query(
    "bench_record",
    f"""WITH {S.REQUESTS} SELECT framework, 'models/' || framework AS model_path, round(avg(latency_s), 6) AS avg_latency_seconds,
    round(min(latency_s), 6) AS min_latency_seconds, round(max(latency_s), 6) AS max_latency_seconds,
    round(quantile_cont(latency_s, 0.5), 6) AS p50_latency_seconds, round(quantile_cont(latency_s, 0.9), 6) AS p90_latency_seconds,
    round(quantile_cont(latency_s, 0.99), 6) AS p99_latency_seconds, round(avg(rate), 6) AS avg_throughput_tokens_per_sec,
    sum(tokens_generated)::BIGINT AS total_tokens_generated, coalesce(max(memory_used_gb), 0)::DOUBLE AS peak_memory_gb,
    round(coalesce(avg(memory_used_gb), 0), 6) AS avg_memory_gb, count(*) AS num_prompts, 3 AS num_warmup_runs, 256 AS max_new_tokens,
    0.7::DOUBLE AS temperature, round(sum(latency_s), 6) AS total_benchmark_time_seconds, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS timestamp
    FROM timed GROUP BY framework""",
)
def bench_record(spark, sf_dir):
    """The full record of every framework's benchmark, written as JSON and read back."""
    path, log = shared_folder(spark, "bench-records"), tables.requests(spark, sf_dir)
    ends = log.groupBy("framework").agg(
        F.sum("latency_s").alias("total_time_s"), F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    )
    summary = requests.benchmark_summary(log).join(ends, "framework").withColumn("model_path", F.concat(F.lit("models/"), "framework"))
    writers.save_records(writers.full_benchmark_record(summary, num_warmup_runs=3, max_new_tokens=256, temperature=0.7), path)
    return readers.read_benchmark_records(spark, path)


@query(
    "memory_gib",
    """SELECT event_id AS request_id, round((value * 1000000)::BIGINT / 1073741824.0::DOUBLE, 6) AS from_bytes,
    round((user_id * 100) / 1024.0::DOUBLE, 6) AS from_mib FROM events""",
)
def memory_gib(spark, sf_dir):
    """Memory readings in bytes, as one client logs them, and in MiB, as another does."""
    events = tables.table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("request_id"),
        units.gib(F.round(F.col("value") * 1_000_000).cast("long"), "bytes").alias("from_bytes"),
        units.gib(F.col("user_id") * 100, "mib").alias("from_mib"),
    )


@query(
    "framework_status",
    f"""WITH {S.REQUESTS} SELECT framework, CASE WHEN count(*) FILTER (WHERE latency_s >= 400) = 0 THEN 'ok' ELSE 'error' END AS status,
    min('timeout after ' || memory_used_gb::INT::VARCHAR) FILTER (WHERE latency_s >= 400) AS error,
    count(*) FILTER (WHERE latency_s >= 400) AS failed FROM timed GROUP BY framework""",
)
def framework_status(spark, sf_dir):
    message = F.concat(F.lit("timeout after "), F.col("memory_used_gb").cast("int").cast("string"))
    return requests.step_status(tables.requests(spark, sf_dir), F.col("latency_s") >= 400, message)


@query(
    "generation_time",
    f"""WITH {S.REQUESTS} SELECT framework,
    round(max(epoch_us(ts) / 1e6 + latency_s) - min(epoch_us(ts) / 1e6), 6) AS generation_time_s FROM req GROUP BY framework""",
)
def generation_time(spark, sf_dir):
    return generate.generation_time(tables.requests(spark, sf_dir))


@query(
    "latency_histogram",
    f"""WITH {S.REQUESTS}, spans AS (SELECT min(latency_s) AS low, max(latency_s) - min(latency_s) AS span FROM req)
    SELECT 'latency_s' AS metric, bin, round(any_value(low) + bin * any_value(span) / 50, 6) AS bin_start, count(*) AS n
    FROM (SELECT low, span, least(floor((latency_s - low) / span * 50), 49)::BIGINT AS bin FROM req, spans) GROUP BY bin""",
)
def latency_histogram(spark, sf_dir):
    return profile.histogram(tables.requests(spark, sf_dir), ["latency_s"])


def _windows(having: str) -> str:
    return f"""WITH {S.REQUESTS} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, framework, count(*) AS num_requests,
    round(avg(latency_s), 6) AS avg_latency_s, round(max(latency_s), 6) AS max_latency_s, round(avg(rate), 6) AS avg_throughput,
    sum(tokens_generated)::BIGINT AS total_tokens FROM timed {having} GROUP BY date_trunc('day', ts), framework"""


def _request_stream(spark, sf_dir):
    schema = tables.table(spark, sf_dir, "events").schema
    log = tables.as_requests(jobs.file_stream(spark, sf_dir, schema, "events.parquet"))
    return jobs.request_windows(log)


def _with_day(windows):
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query("bench_stream", _windows(""))
def bench_stream(spark, sf_dir):
    """Daily request windows from a stream, the last ones included: the newest state of every window."""
    return _with_day(jobs.run_updates(_request_stream(spark, sf_dir), "windows", ("window_start", "framework")))


@query(
    "bench_stream_closed",
    _windows("WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM req)"),
)
def bench_stream_closed(spark, sf_dir):
    """Daily request windows from a stream, each reported once, when the watermark has passed its end."""
    return _with_day(jobs.run_to_end(_request_stream(spark, sf_dir), "windows"))


# -- training runs ----------------------------------------------------------------------


@query(
    "latest_model",
    f"""WITH {S.RUNS} SELECT framework, run_id, kind, concat_ws('/', 'outputs', framework, run_id, kind) AS path FROM (
      SELECT framework, run_id, CASE WHEN has_merged THEN 'merged_model' ELSE 'adapter' END AS kind,
      row_number() OVER (PARTITION BY framework ORDER BY run_id DESC, tie_break DESC) AS n
      FROM runs WHERE has_merged OR has_adapter) WHERE n = 1""",
)
def latest_model(spark, sf_dir):
    return runs.latest_model(tables.runs(spark, sf_dir))


@query(
    "latest_stats",
    f"""WITH {S.RUNS} SELECT framework, run_id FROM (SELECT *, row_number() OVER (PARTITION BY framework
      ORDER BY run_id DESC, tie_break DESC) AS n FROM runs) WHERE n = 1 AND has_stats""",
)
def latest_stats(spark, sf_dir):
    return runs.latest_stats(tables.runs(spark, sf_dir))


@query(
    "training_figures",
    """SELECT event_type AS framework, event_id AS run_no, round(value * 60, 6) AS training_time_seconds,
    round(value * 60 / 60, 6) AS training_time_minutes, 2 * (user_id % 8 + 1) AS effective_batch_size FROM events""",
)
def training_figures(spark, sf_dir):
    figures = runs.training_figures(tables.training_stats(spark, sf_dir))
    return figures.drop("per_device_batch", "accumulation_steps")


@query(
    "early_stop",
    """WITH log AS (SELECT user_id AS run, value AS loss, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
    marked AS (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM log),
    since AS (SELECT run, step, loss, step - max(CASE WHEN best IS NULL OR loss < best THEN step END) OVER (PARTITION BY run ORDER BY step) AS stalled FROM marked),
    stops AS (SELECT run, min(step) FILTER (WHERE stalled >= 3) AS stop_step, max(step) AS num_steps FROM since GROUP BY run),
    kept AS (SELECT log.*, stop_step, num_steps, row_number() OVER (PARTITION BY run ORDER BY loss, step) AS n
             FROM log JOIN stops USING (run) WHERE stop_step IS NULL OR step <= stop_step)
    SELECT run, stop_step, step AS best_step, round(loss, 6) AS best_loss, num_steps FROM kept WHERE n = 1""",
)
def early_stop(spark, sf_dir):
    return runs.early_stop(tables.eval_log(spark, sf_dir))


@query(
    "run_times",
    f"""WITH {S.RUNS} SELECT framework, tie_break, strftime(strptime(run_id, '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') AS begun FROM runs""",
)
def run_times(spark, sf_dir):
    """When each run began, by its id."""
    begun = F.date_format(runs.run_time(F.col("run_id")), "yyyy-MM-dd HH:mm:ss")
    return tables.runs(spark, sf_dir).select("framework", "tie_break", begun.alias("begun"))


@query(
    "training_log",
    """SELECT event_type AS framework, count(*) AS runs, round(sum(value * 60), 3) AS training_time_seconds FROM events GROUP BY event_type""",
)
def training_log(spark, sf_dir):
    """Training statistics appended in two writes and read back, by the folders of their frameworks."""
    path, stats = shared_folder(spark, "training-log"), tables.training_stats(spark, sf_dir)
    for part in range(2):
        writers.append_training_stats(stats.where(F.col("run_no") % 2 == part), path)
    stored = spark.read.schema("framework STRING, run_no BIGINT, training_time_seconds DOUBLE").json(path)
    return stored.groupBy("framework").agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.sum("training_time_seconds"), 3).alias("training_time_seconds")
    )


@query(
    "labelled_summary",
    f"""WITH {S.REQUESTS} SELECT framework, CASE framework WHEN 'click' THEN 'Click (local)' WHEN 'view' THEN 'View (batched)' ELSE framework END AS label,
    count(*) AS num_requests FROM req GROUP BY framework""",
)
def labelled_summary(spark, sf_dir):
    counts = tables.requests(spark, sf_dir).groupBy("framework").agg(F.count(F.lit(1)).alias("num_requests"))
    return compare.with_labels(counts, {"click": "Click (local)", "view": "View (batched)"})


@query(
    "comparison_csv",
    f"""WITH {S.REQUESTS} SELECT framework, round(avg(latency_s), 6) AS avg_latency_s, round(avg(rate), 6) AS avg_throughput FROM timed GROUP BY framework""",
)
def comparison_csv(spark, sf_dir):
    """A comparison table saved as CSV and read back."""
    path = shared_folder(spark, "comparison")
    means = requests.mean_std_summary(tables.requests(spark, sf_dir)).select("framework", "avg_latency_s", "avg_throughput")
    writers.save_comparison(means, path)
    return spark.read.schema("framework STRING, avg_latency_s DOUBLE, avg_throughput DOUBLE").option("header", True).csv(path)
