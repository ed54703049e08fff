"""Nearest neighbours by inner product, with a vantage-point tree for every shard of the vectors.

Inner products become distances on a sphere: every vector is scaled by the largest norm M
and gets one more component that completes it to length one; queries are scaled to length
one with a zero there. Then a larger inner product is a smaller distance.

In a tree, a node keeps a vantage point and the median distance to it; a query goes to its
own side first. By the triangle inequality the other side cannot hold a nearer vector if
the query is further from the boundary than from its worst neighbour so far. ``factor``
divides that worst distance: 1 prunes only what is certain (exact search), more prunes
earlier. A tree is built once for a lane of queries, which pass it in blocks of bounded size;
lanes bound the work of a task. The best lists of the shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import written

K = 20
FACTOR = 1.0
SHARD_ROWS = 8192
QUERY_ROWS = 2048
#: Query blocks that pass one tree in one task. Candidates are copied once for so many blocks.
LANE_BLOCKS = 64
#: Most tasks the shards are dealt to; a task may hold many shards, one after another.
MOST_TASKS = 20_000
LEAF_ROWS = 128
#: Allowance for rounding in distances, on the side of searching more.
SLACK = 1e-6

FOUND = "query_id long, vec_id long, score double"


class VantageTree:
    """A tree over rows of ``points`` (unit vectors), split by rank, so that equal points do not unbalance it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS, seed: int = 7):
        self.points, self.leaf = points, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = self.points[rows[self.rng.integers(len(rows))]]
        distance = distances(vantage[None, :], self.points[rows])[0]
        order = np.argsort(distance, kind="stable")
        half = len(rows) // 2
        inner, outer = rows[order[:half]], rows[order[half:]]
        # the largest distance inside and the smallest outside: both sides of the shell
        return vantage, distance[order[half - 1]], distance[order[half]], self._build(inner), self._build(outer)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Search:
    """Best ``k`` of one shard for a block of queries."""

    def __init__(self, tree: VantageTree, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, largest: float, k: int, factor: float):
        self.tree, self.ids, self.vectors, self.queries, self.query_ids = tree, ids, vectors, queries, query_ids
        self.k, self.factor = k, factor
        self.norms = np.sqrt((queries * queries).sum(axis=1))
        self.largest = largest
        unit = queries / self.norms[:, None]
        self.unit = np.hstack([unit, np.zeros((len(unit), 1))])
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def reach(self, rows: np.ndarray) -> np.ndarray:
        """Distance of the worst neighbour kept (two: none yet), relaxed by the factor."""
        cosine = self.scores[rows, -1] / (self.norms[rows] * self.largest)
        worst = np.where(np.isfinite(cosine), np.sqrt(np.maximum(2 - 2 * np.clip(cosine, -1, 1), 0)), 2.0)
        return worst / self.factor + SLACK

    def visit(self, node, rows: np.ndarray) -> None:
        if len(rows) == 0:
            return
        if isinstance(node, np.ndarray):
            return self._leaf(node, rows)
        vantage, inside, outside, inner, outer = node
        far = distances(self.unit[rows], vantage[None, :])[:, 0]
        nearer_inside = far <= (inside + outside) / 2
        self.visit(inner, rows[nearer_inside])
        self.visit(outer, rows[~nearer_inside])
        # the other side, where it may still hold something nearer
        reach = self.reach(rows)
        self.visit(outer, rows[nearer_inside & (outside - far <= reach)])
        self.visit(inner, rows[~nearer_inside & (far - inside <= reach)])

    def _leaf(self, leaf: np.ndarray, rows: np.ndarray) -> None:
        for begin in range(0, len(rows), 512):
            some = rows[begin : begin + 512]
            # the same order of additions for every pair, so that equal vectors have equal scores
            score = np.einsum("qd,vd->qv", self.queries[some], self.vectors[leaf])
            ids = np.broadcast_to(self.ids[leaf], score.shape)
            score[ids == self.query_ids[some][:, None]] = -np.inf
            both = np.concatenate([self.scores[some], score], axis=1)
            names = np.concatenate([self.found[some], ids], axis=1)
            order = np.lexsort((names, -both), axis=1)[:, : self.k]
            self.scores[some] = np.take_along_axis(both, order, 1)
            self.found[some] = np.take_along_axis(names, order, 1)


def matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(float)


def plant(ids: np.ndarray, points: np.ndarray, largest: float) -> VantageTree:
    """The tree of one shard, over its vectors completed to length one."""
    scaled = points / largest
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return VantageTree(np.hstack([scaled, rest[:, None]]))


def search_shards(batches: Iterator[pa.RecordBatch], largest: float, k: int, factor: float, query_rows: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` in each shard for each query; rows come by shard and lane, candidates before queries.

    The tree is built when the first query comes; queries pass it ``query_rows`` at a time. Memory holds one
    shard and one batch.
    """
    shard, gathered, planted = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in ("size", "shard", "lane", "asks")], axis=1)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *starts], [*starts, len(keys)]):
            if begin == end:
                continue
            *key, asks = keys[begin]
            if shard != key:
                shard, gathered, planted = key, [], None
            part = batch.slice(begin, end - begin)
            ids, points = part.column("vec_id").to_numpy(), matrix(part.column("vector"))
            if not asks:
                gathered.append((ids, points))
                continue
            if not gathered and planted is None:
                continue  # a shard without candidates
            if planted is None:
                every_id, every = np.concatenate([g[0] for g in gathered]), np.concatenate([g[1] for g in gathered])
                planted, gathered = (plant(every_id, every, largest), every_id, every), []
            for at in range(0, len(ids), query_rows):
                yield search_block(*planted, points[at : at + query_rows], ids[at : at + query_rows], largest, k, factor)


def search_block(
    tree: VantageTree, ids: np.ndarray, points: np.ndarray, asked: np.ndarray, query_ids: np.ndarray, largest: float, k: int, factor: float
) -> pa.RecordBatch:
    """The best ``k`` in one shard for one block of queries."""
    search = Search(tree, ids, points, asked, query_ids, largest, k, factor)
    search.visit(tree.root, np.arange(len(asked)))
    kept = np.isfinite(search.scores)
    return pa.RecordBatch.from_pydict(
        {
            "query_id": pa.array(np.repeat(query_ids, kept.sum(axis=1))),
            "vec_id": pa.array(search.found[kept]),
            "score": pa.array(search.scores[kept]),
        }
    )


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector, size``: one row per id, without null ids and without null, zero or non-finite vectors.

    Of rows that share an id the smallest vector is taken, so repeated rows count once.
    """
    broken = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vector = F.col("embedding")
    return (
        embeddings.where(F.col("vec_id").isNotNull() & vector.isNotNull())
        .where(~F.exists(vector, broken) & F.exists(vector, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def nearest(
    embeddings: DataFrame,
    query_every: int = 20,
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every id divisible by ``query_every`` its ``k`` nearest others.

    Nearness is the inner product in double precision on the original vectors, ties go to
    the smaller id. Vectors of another length than the query's are no candidates. With
    fewer candidates than ``k`` all are returned; a lone vector has no row.
    """
    vectors = written(usable(embeddings), "search-vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, queries_n, largest = vectors.agg(
        F.count("*"), F.count(F.when(F.col("vec_id") % query_every == 0, 1)), F.max(F.sqrt(square))
    ).first()
    shards, lanes = -(-n // shard_rows) or 1, -(-queries_n // (query_rows * LANE_BLOCKS)) or 1
    largest = float(largest or 1.0) * (1 + 1e-12)

    # candidates go to their shard once a lane, queries to every shard; in a shard and lane candidates come first
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(count)).cast("int")
    candidates = vectors.select("size", dealt(shards, 1).alias("shard"), every(lanes).alias("lane"), F.lit(0).alias("asks"), "vec_id", "vector")
    asked = vectors.where(F.col("vec_id") % query_every == 0).select(
        "size", every(shards).alias("shard"), dealt(lanes, 2).alias("lane"), F.lit(1).alias("asks"), "vec_id", "vector"
    )
    keys = ["size", "shard", "lane"]
    # more tasks than shards, so that few shards share one by chance
    spread = candidates.unionAll(asked).repartition(min(4 * shards * lanes, MOST_TASKS), *keys)
    found = spread.sortWithinPartitions(*keys, "asks").mapInArrow(
        lambda batches: search_shards(batches, largest, k, factor, query_rows), FOUND
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
