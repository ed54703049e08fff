"""Explicit schemas, as DDL, of the tables and files the library reads and writes."""

from __future__ import annotations

INSTRUCT = (
    "id BIGINT, instruction STRING, context STRING, response STRING, category STRING"
)
EVAL = (
    "id BIGINT, prompt STRING, reference STRING, instruction STRING, context STRING, category STRING"
)
TOKENS = (
    "id BIGINT, input_ids ARRAY<INT>, attention_mask ARRAY<INT>, labels ARRAY<INT>"
)
PREDICTION = ("model STRING, id BIGINT, prediction STRING")
# Stored samples are of either layout: with a prompt, or with the parts of one.
SAMPLES = (
    "id BIGINT, prompt STRING, instruction STRING, context STRING, reference STRING, generated STRING, "
    "prediction STRING, category STRING"
)

# The base model's file names its model in `model`, the others in `model_name`.
EVAL_FILE = (
    "model STRING, model_name STRING, model_path STRING, timestamp STRING, num_samples INT, "
    "generation_time_s DOUBLE, metrics STRUCT<bleu: DOUBLE, bleu_1: DOUBLE, bleu_2: DOUBLE, "
    "bleu_3: DOUBLE, bleu_4: DOUBLE, "
    "rouge_1: DOUBLE, rouge_2: DOUBLE, rouge_l: DOUBLE, bertscore_precision: DOUBLE, "
    "bertscore_recall: DOUBLE, bertscore_f1: DOUBLE>"
)
BENCH_FILE = (
    "framework STRING, timestamp STRING, model_path STRING, model_name STRING, "
    "config STRUCT<num_prompts: INT, num_trials: INT, max_new_tokens: INT>, "
    "results STRUCT<avg_latency_s: DOUBLE, std_latency_s: DOUBLE, avg_tokens_generated: DOUBLE, "
    "avg_throughput_tokens_per_s: DOUBLE, std_throughput: DOUBLE, peak_memory_gb: DOUBLE, "
    "load_time_s: DOUBLE>"
)
# The record of a single benchmark, all figures beside each other.
BENCH_RECORD = (
    "framework STRING, model_path STRING, avg_latency_seconds DOUBLE, min_latency_seconds DOUBLE, "
    "max_latency_seconds DOUBLE, p50_latency_seconds DOUBLE, p90_latency_seconds DOUBLE, p99_latency_seconds DOUBLE, "
    "avg_throughput_tokens_per_sec DOUBLE, total_tokens_generated BIGINT, peak_memory_gb DOUBLE, avg_memory_gb DOUBLE, "
    "num_prompts BIGINT, num_warmup_runs INT, max_new_tokens INT, temperature DOUBLE, "
    "total_benchmark_time_seconds DOUBLE, timestamp STRING"
)
REQUEST = (
    "framework STRING, request_id BIGINT, ts TIMESTAMP, latency_s DOUBLE, "
    "tokens_generated INT, memory_used_gb DOUBLE"
)
_RATINGS = "STRUCT<helpfulness: INT, factuality: INT, instruction_following: INT>"
ANNOTATION = (
    "id BIGINT, prompt STRING, reference STRING, generated STRING, helpfulness INT, "
    "factuality INT, instruction_following INT, notes STRING"
)
RATING = ("sample_id BIGINT, system STRING, criterion STRING, score INT")
TRAIN_STATS = (
    "framework STRING, training_time_seconds DOUBLE, training_time_minutes DOUBLE, "
    "peak_memory_gb DOUBLE, train_loss DOUBLE, eval_loss DOUBLE, train_samples INT, epochs INT, "
    "effective_batch_size INT, lora_rank INT, learning_rate DOUBLE, timestamp STRING"
)
RUN = (
    "framework STRING, run_id STRING, has_merged BOOLEAN, has_adapter BOOLEAN, has_stats BOOLEAN"
)
EVAL_LOG = ("run BIGINT, step BIGINT, eval_loss DOUBLE")
MESSAGES = ("conv_id BIGINT, turn BIGINT, role STRING, content STRING")
TOKEN_VEC = ("token STRING, vec ARRAY<FLOAT>")

# Rating criteria, in reporting order.
CRITERIA = ("helpfulness", "factuality", "instruction_following")


def nested_ratings(systems: tuple[str, ...]) -> str:
    """Rated samples with one answer and one rating struct per system."""
    answers = [f"generated_{s} STRING" for s in systems] + [f"eval_{s} {_RATINGS}" for s in systems]
    return "id INT, instruction STRING, context STRING, prompt STRING, reference STRING, " + ", ".join(answers)
