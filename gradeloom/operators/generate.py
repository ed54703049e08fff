"""Batch generation with a pluggable engine."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An engine takes a list of prompts and returns one answer per prompt: a text, or a mapping
# with a ``text`` and, where it knows them, ``tokens``, ``memory_gb`` and ``metadata``.
Engine = Callable[[list[str]], list]
EngineFactory = Callable[..., Engine]

GENERATED = (
    "text STRING, tokens_generated INT, latency_s DOUBLE, tokens_per_second DOUBLE, "
    "memory_used_gb DOUBLE, metadata MAP<STRING, BIGINT>, status STRING, error STRING"
)


def _echo_engine(**options) -> Engine:
    """Deterministic stand-in: the prompt's words in reverse, at most ``max_new_tokens`` when given."""
    limit = options.get("max_new_tokens")

    def answer(prompts: list[str]) -> list[str]:
        return [" ".join(p.split()[::-1][:limit]) for p in prompts]

    return answer


ENGINES: dict[str, EngineFactory] = {"echo": _echo_engine}


def register_engine(name: str, factory: EngineFactory) -> None:
    ENGINES[name.lower()] = factory


def engine_factory(name: str) -> EngineFactory:
    key = name.lower()
    if key not in ENGINES:
        raise ValueError(f"unknown engine {name!r}; known: {sorted(ENGINES)}")
    return ENGINES[key]


def batch_generate(
    df: DataFrame,
    engine: str | EngineFactory,
    count_tokens: Callable[[str], int] | None = None,
    timeout_latency: float | None = None,
    batch_rows: int = 64,
    **options,
) -> DataFrame:
    """Rows with a ``prompt`` column plus text, token count, latency and status.

    The factory runs once per task; prompts go to the engine in groups of
    ``batch_rows``, and each request's latency is its group's time divided by the
    group size. A group that fails, misses an answer or cannot be measured is retried
    prompt by prompt; a prompt that fails on its own keeps its row, with the error and no text. ``timeout_latency`` puts
    that latency, 0 tokens and 0 throughput on failed rows instead of nulls.
    """
    factory = engine_factory(engine) if isinstance(engine, str) else engine
    measure = count_tokens or (lambda text: len(text.split()))
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(GENERATED).fields)

    def read(given) -> tuple[dict, int]:
        known = {"text": given} if isinstance(given, str) else given
        if known is None or known.get("text") is None:
            raise ValueError("no answer")
        return known, known["tokens"] if "tokens" in known else measure(known["text"])

    def ask(answer: Engine, prompts: list[str]) -> list[tuple]:
        begun = time.perf_counter()
        try:
            answers = [read(given) for given in answer(prompts)]
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
        except Exception as failure:
            if len(prompts) > 1:
                return [row for p in prompts for row in ask(answer, [p])]
            failed = (None, None, None) if timeout_latency is None else (0, timeout_latency, 0.0)
            return [(None, *failed, None, None, "error", str(failure))]
        each = (time.perf_counter() - begun) / len(prompts)
        rows = []
        for known, n in answers:
            rate = n / each if each > 0 else 0.0
            rows.append((known["text"], n, each, rate, known.get("memory_gb"), known.get("metadata"), "ok", None))
        return rows

    names = [f.name for f in T.StructType.fromDDL(GENERATED).fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = factory(**options)
        for frame in batches:
            for start in range(0, len(frame), batch_rows):
                part = frame.iloc[start:start + batch_rows].reset_index(drop=True)
                rows = ask(answer, part["prompt"].fillna("").tolist())
                yield pd.concat([part, pd.DataFrame(rows, columns=names)], axis=1)

    return df.mapInPandas(run, schema)


def generation_time(requests: DataFrame, by: tuple[str, ...] = ("framework",)) -> DataFrame:
    """Wall time of a batch: last end minus first start."""
    begin = F.unix_micros("ts") / 1e6
    return requests.groupBy(*by).agg(
        (F.max(begin + F.col("latency_s")) - F.min(begin)).alias("generation_time_s")
    )
