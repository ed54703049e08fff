"""Every registered query against its SQL counterpart, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple("" if v is None else repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, sf_dir, duck, name):
    df = entry_points.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    assert rows
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=_key)
    assert len(rows) == len(expected)
    for mine, theirs in zip(rows, expected):
        assert mine == theirs


def test_entry(spark, sf_dir):
    card = entry_points.entry(spark)
    assert "bleu_4" in card.columns and card.count() == 3
