"""Ranked lexical search over an index that is stratified by document length.

The index is written in shards, one per block of documents. A shard's documents are
numbered by length, so those of equal normaliser m, a stratum, stand side by side and a
term's postings fall into one run per stratum. It holds lengths, not m, so shards can be
added without touching those that stand.

A search takes every shard against a block of items. Impacts follow once per (stratum, tf);
the largest of each run bounds what a stratum can score. For an item strata are visited by
falling bound, until the bound is below its k-th best score. Scores are whole numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.blocks import BLOCK_BYTES, BLOCK_ROWS, block_ids, parts, ranges
from gradeloom.llm.common import slices, written

TOP = 50
#: Items that are searched together in a shard.
ITEM_BLOCK = 1024
#: Rows of the index that are passed on at once.
PIECE = 16_384

#: Characters of no term, for both of the engines that read patterns.
OTHER = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = re.compile(rf"[^{OTHER}]+".encode())

#: ``term`` null: ``numbers`` are the shard's document ids, ``counts`` their lengths in terms.
#: Else ``numbers`` are positions in that list, ascending, ``counts`` the term's occurrences.
INDEX = "shard long, term string, n_docs int, numbers array<long>, counts array<long>"


def find_terms(raw: bytes) -> list[bytes]:
    """On UTF-8 bytes: lower() changes A-Z alone, and every byte from 0x80 belongs to a term."""
    return _TERM.findall(raw.lower())


def item_terms(text: Column) -> Column:
    """The distinct terms of a text, as a native array."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"([^{OTHER}]+)"), F.lit(1)))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _shard(shard: int, ids: list[pa.Array], found: list[pa.Array], lengths: list[int]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "term", "n_docs", "numbers", "counts"]
    n = np.array(lengths, np.int64)
    order = np.argsort(n, kind="stable")
    place = np.empty(len(n), np.int64)
    place[order] = np.arange(len(n))
    doc_ids = pa.concat_arrays(ids).take(pa.array(order))
    one = pa.array([0, len(n)], pa.int32())
    head = [[shard], [None], [len(n)], pa.ListArray.from_arrays(one, doc_ids), _lists(n[order], np.array([0, len(n)]))]
    types = [pa.int64(), pa.string(), pa.int32()]
    yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(head, types)), *head[3:]], names=names)

    coded = pa.chunked_array(found, pa.binary()).combine_chunks().dictionary_encode()
    if not len(coded):
        return
    keys = coded.indices.to_numpy().astype(np.int64) * len(n) + np.repeat(place, n)
    keys.sort()
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    tf = np.diff(np.append(new, len(keys)))
    term, numbers = np.divmod(keys[new], len(n))
    edges = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))
    terms = coded.dictionary.cast(pa.string())
    for begin in range(0, len(edges) - 1, PIECE):
        cut = edges[begin : begin + PIECE + 1]
        some, offsets = slice(cut[0], cut[-1]), cut - cut[0]
        columns = [
            pa.array(np.full(len(cut) - 1, shard)),
            terms.slice(begin, len(cut) - 1),
            pa.array(np.diff(cut), pa.int32()),
            _lists(numbers[some], offsets),
            _lists(tf[some], offsets),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def build_index(docs: DataFrame, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """The written index of every row of ``docs`` (``doc_id, text``) over whole texts.

    Null and empty texts are documents without terms. Rows are told apart by their place,
    so null and repeated ids each stand for a document. An empty table has no shards.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_ids()
        ids, found, lengths = [], [], []
        for block, last in parts(batches, rows, size):
            for part in slices(iter([block])):
                ids.append(part.column("doc_id").cast(pa.int64()))
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    terms = find_terms(text or b"")
                    found.append(pa.array(terms, pa.binary()))
                    lengths.append(len(terms))
            if last:
                yield from _shard(next(numbers), ids, found, lengths)
                ids, found, lengths = [], [], []

    return written(docs.select("doc_id", "text").mapInArrow(index, INDEX), "lexical-index")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, equal ones by id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        rows = np.flatnonzero(scores >= least)
    else:
        rows = np.arange(len(scores))
    return rows[np.lexsort((ids[rows], -scores[rows]))][:k]


def visit(
    lengths: np.ndarray, ids: np.ndarray, terms: list[tuple], n_docs: int, n_terms: int, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per item its best documents of a shard: ``item, positions, scores``.

    ``terms`` holds ``(numbers, counts, weight, items)`` per term of the shard that an item has.
    """
    if not terms:
        return
    stratum_n, stratum_of = np.unique(lengths, return_inverse=True)
    own_m, same = np.unique(np.array([50 + 50 * int(n) * n_docs // n_terms for n in stratum_n], np.int64), return_inverse=True)
    stratum_of = same[stratum_of]  # of a document, ascending
    sizes = np.bincount(stratum_of, minlength=len(own_m))

    docs = np.concatenate([t[0] for t in terms])
    tf = np.concatenate([t[1] for t in terms])
    term_of = np.repeat(np.arange(len(terms)), [len(t[0]) for t in terms])
    weights = np.array([t[2] for t in terms], np.int64)
    stratum = stratum_of[docs]
    base = int(tf.max()) + 1
    codes, which = np.unique(stratum * base + tf, return_inverse=True)
    own_stratum, own_tf = np.divmod(codes, base)
    impact = (1_000_000_000 * own_tf) // (1000 * own_tf + 20 * own_m[own_stratum])
    gain = weights[term_of] * impact[which]
    runs = np.flatnonzero(np.diff(term_of * len(own_m) + stratum, prepend=-1))
    highest, run_stratum = np.maximum.reduceat(gain, runs), stratum[runs]
    posting_edges = np.searchsorted(term_of, np.arange(len(terms) + 1))
    run_edges = np.searchsorted(term_of[runs], np.arange(len(terms) + 1))

    holders: dict[int, list[int]] = {}
    for t, row in enumerate(terms):
        for item in row[3]:
            holders.setdefault(item, []).append(t)
    for item, own in holders.items():
        mine = np.array(own)
        sel = ranges(run_edges[mine], run_edges[mine + 1])
        bound = np.zeros(len(own_m), np.int64)
        np.add.at(bound, run_stratum[sel], highest[sel])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        if not len(order):
            continue
        # a visit takes strata with as many documents as all visits before it together
        turns = np.maximum(np.log2(np.cumsum(sizes[order]) / (2 * k)), 0).astype(np.int64)
        turn_of = np.full(len(own_m), -1)
        turn_of[order] = turns
        sel = ranges(posting_edges[mine], posting_edges[mine + 1])
        turn = turn_of[stratum[sel]]
        best_rows, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for now in np.unique(turns):
            if len(best_scores) == k and bound[order[np.searchsorted(turns, now)]] < best_scores[-1]:
                break
            seen = sel[turn == now]
            rows, at = np.unique(docs[seen], return_inverse=True)
            scores = np.zeros(len(rows), np.int64)
            np.add.at(scores, at, gain[seen])
            rows, scores = np.append(best_rows, rows[scores > 0]), np.append(best_scores, scores[scores > 0])
            chosen = _best(scores, ids[rows], k)
            best_rows, best_scores = rows[chosen], scores[chosen]
        yield item, best_rows, best_scores


def search(index: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every row of ``items`` (``item_id, text``).

    Only scores above 0; equal scores by ascending id, a null id last. Items without terms
    (null or empty texts) and an empty index have no rows; rows of one item id are items of
    their own. Totals are two numbers; weights stay a table, joined by term.
    """
    queries = written(
        items.select(F.monotonically_increasing_id().alias("item"), "item_id", item_terms(F.col("text")).alias("terms")),
        "lexical-items",
    )
    n_blocks = max(1, ceil(queries.count() / ITEM_BLOCK))
    heads, postings = index.where(F.col("term").isNull()), index.where(F.col("term").isNotNull())
    total = lambda f: F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + f(n)))
    n_docs, n_terms = heads.agg(total(lambda n: (n > 0).cast("long")), total(lambda n: n)).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0

    asked = queries.select("item", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).alias("block"), F.explode("terms").alias("term"))
    asked = written(asked.groupBy("term", "block").agg(F.collect_list("item").alias("items")), "lexical-terms")
    df = postings.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    weighted = written(asked.join(df.select("term", weight.alias("weight")), "term"), "lexical-weights")

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))
    rows = (
        postings.join(weighted, "term")
        .select("shard", "block", "numbers", "counts", "weight", "items")
        .unionByName(
            heads.select("shard", every.alias("block"), "numbers", "counts"),
            allowMissingColumns=True,
        )
    )

    def best(group: pa.Table) -> pa.Table:
        at = {name: group.column(name) for name in ("numbers", "counts", "weight", "items")}
        ids, lengths, terms = np.empty(0, np.int64), np.empty(0, np.int64), []
        known = pa.array([], pa.int64())
        for numbers, counts, own_weight, own_items in zip(at["numbers"], at["counts"], at["weight"], at["items"]):
            if own_items.is_valid:
                terms.append((numbers.values.to_numpy(), counts.values.to_numpy(), own_weight.as_py(), own_items.as_py()))
            else:
                known, lengths = numbers.values, counts.values.to_numpy()
        ids = known.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        out = list(visit(lengths, ids, terms, n_docs, n_terms, k))
        places = np.concatenate([np.empty(0, np.int64), *(p for _, p, _ in out)])
        columns = [
            pa.array(np.repeat(np.array([i for i, _, _ in out], np.int64), [len(p) for _, p, _ in out])),
            known.take(pa.array(places)),
            pa.array(np.concatenate([np.empty(0, np.int64), *(s for _, _, s in out)])),
        ]
        return pa.table(columns, names=["item", "doc_id", "score"])

    found = rows.groupBy("shard", "block").applyInArrow(best, "item long, doc_id long, score long")
    falling = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= k)
    return ranked.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: The same result by joins over all terms of all documents.
SQL = f"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS place,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{OTHER}]+') AS terms
  FROM documents WHERE text IS NOT NULL
), lengths AS (SELECT doc_id, place, len(terms) AS n FROM words WHERE len(terms) > 0
), totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), found AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM words) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM found, totals GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT place AS item, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS place, item_id,
           regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{OTHER}]+') AS terms
    FROM benchmark WHERE text IS NOT NULL)
), scores AS (
  SELECT item, item_id, doc_id, place,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN found USING (term) JOIN lengths USING (place), totals
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
