"""Ranked lexical search against a plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gradeloom.llm import blocks, lexical_search
from gradeloom.llm.catalog import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=50):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c in counts:
            if not c:
                continue
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
            score = 0
            for t in set(plain_terms(text)) & set(c):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort(key=lambda f: f[:3])
        out += Counter((item, rank, i, -s) for rank, (s, _, _, i) in enumerate(found[:k], 1))
    return out


def got(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}é" for _ in range(3000)]
    made = [" ".join(rng.choice(words) for _ in range(int(rng.paretovariate(0.8)) % 700)) for _ in range(500)]
    return made + made[:80] + ["The FOX, the fox!"] * 3


@pytest.mark.parametrize("rows, size", [(8192, 1 << 24), (40, 1 << 24), (8192, 3000)])
def test_matches_plain_scores_over_any_shards(spark, texts, rows, size):
    docs = list(enumerate(texts))
    random.Random(6).shuffle(docs)
    items = [(i, " ".join(texts[i].split()[:20]) + " fox") for i in range(12)]
    index = lexical_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), rows, size)
    found = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), 7)
    assert got(found) == plain_search(docs, items, 7)
    assert index.where("term is null").select("shard").distinct().count() == index.where("term is null").count()


def test_items_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEM_BLOCK", 4)
    docs = list(enumerate(texts[:200]))
    items = [(i % 9, " ".join(texts[i].split()[:9])) for i in range(17)]  # rows of one id are items of their own
    index = lexical_search.build_index(spark.createDataFrame(docs, "doc_id long, text string"), 60)
    found = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == plain_search(docs, items)


def test_bounds_leave_strata_unvisited(monkeypatch):
    looked = []
    real = lexical_search._best
    monkeypatch.setattr(lexical_search, "_best", lambda s, i, k: looked.append(len(s)) or real(s, i, k))
    lengths = np.sort(np.repeat(np.arange(10, 400), 5))
    rare = (np.arange(30), np.full(30, 9), 8000, [0])
    common = (np.arange(len(lengths)), np.ones(len(lengths), np.int64), 1, [0])
    [(_, rows, _)] = lexical_search.visit(lengths, np.arange(len(lengths)), [rare, common], len(lengths), int(lengths.sum()), 10)
    assert set(rows) <= set(range(30)) and sum(looked) < 300


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, "Alpha beta"), (4, long), (5, "beta alpha"), (5, "beta alpha"), (None, "alpha beta"), (7, "\n, ."), (8, "alpha ÄÄ 日本")]
    items = [(1, "ALPHA beta alpha"), (2, None), (3, ""), (None, "日本 w5x5"), (4, "nothing here"), (1, "alpha")]
    frame = spark.createDataFrame([(i, t, 1, "x", 2, None) for i, t in docs], "doc_id long, text string, shard int, term string, rank int, score long")
    asked = spark.createDataFrame([(i, t, 1, 7, 2, "x") for i, t in items], "item_id long, text string, rank int, item long, doc_id long, term string")
    assert got(lexical_search.search(lexical_search.build_index(frame), asked)) == plain_search(docs, items)
    empty = lexical_search.build_index(frame.limit(0))
    assert lexical_search.search(empty, asked).count() == 0
    assert lexical_search.search(lexical_search.build_index(frame), asked.limit(0)).count() == 0


def test_blocks_keep_to_their_bounds(spark, texts):
    frame = spark.createDataFrame(list(enumerate([*texts, None, "z" * 50_000])), "doc_id long, text string")
    batch = frame.toArrow().to_batches()
    made, held, rows = [], 0, 0
    for part, last in blocks.parts(iter(batch), 30, 4000):
        held, rows = held + sum(len((t or "").encode()) for t in part.column("text").to_pylist()), rows + part.num_rows
        made += part.column("doc_id").to_pylist()
        if last:
            assert rows <= 30 and (held <= 4000 or rows == 1)
            held = rows = 0
    assert made == list(range(len(texts) + 2))


def test_query_matches_sql(spark, sf_dir):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    expected = Counter(duck.execute(SQL["op13_lexical_search"]).fetchall())
    assert got(QUERIES["op13_lexical_search"](spark, sf_dir)) == expected
