"""Near copies by 64-bit SimHash, found with tables of distances to reference fingerprints.

Every distinct fingerprint gets its Hamming distances to many pivots. Two fingerprints
that differ in at most r bits have distances that differ by at most r, for every pivot.

* The first pivots deal fingerprints into buckets: at each pivot a fingerprint goes to
  the near side (distance <= t + r - 1), the far side (distance >= t), or both. A pair
  within r bits always has one side in common, so no link is lost.
* A bucket is split further in the same way, by the pivots that spread it most.
* In what cannot be split, pairs are discarded pivot by pivot when a coordinate differs
  by more than r; survivors are compared bit by bit.

A bucket answers with one link per fingerprint (to its group's smallest), never with
pairs, so a dense bucket does not multiply rows. Links then grow into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import slices, written

WIDTH = 3
SEED = 42
RADIUS = 2
PIVOTS = 64
BUCKET_ROWS = 8192
LEAF_ROWS = 128
#: Distance at which a random pivot splits 64-bit fingerprints about evenly.
MIDDLE = 31
CELLS = 1 << 20

FINGERPRINTS = "doc_id long, fingerprint string, bits long"


def fingerprint(raw: bytes, width: int = WIDTH) -> bytes:
    """Eight bytes, most significant first: bits set in over half the hashes of the word shingles."""
    words = raw.lower().split()  # on bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return bytes(8)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[begin : begin + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, the fingerprint in hex, and its bits as a signed long, for every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [fingerprint(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array([m.hex() for m in made], pa.string()),
                    pa.array(np.frombuffer(b"".join(made), ">i8").astype(np.int64)),
                ],
                names=["doc_id", "fingerprint", "bits"],
            )

    return docs.select("doc_id", "text").mapInArrow(measure, FINGERPRINTS)


def pivot_fingerprints(pivots: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(20_240_917).integers(0, 1 << 64, pivots, dtype=np.uint64)


def _merge(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give the linked rows of a bucket one label; the work is per pair of labels, not per pair of rows."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
        target = np.arange(len(labels))
        np.minimum.at(target, high, low)
        while True:
            further = target[target]
            if (further == target).all():
                break
            target = further
        labels[:] = target[labels]


def _compare(bits: np.ndarray, table: np.ndarray, rows: np.ndarray, radius: int, labels: np.ndarray) -> None:
    """Link the rows of one leaf: discard pairs by their coordinates, then count differing bits."""
    order = np.argsort(-table[rows].var(axis=0), kind="stable") if len(rows) > LEAF_ROWS else range(table.shape[1])
    step = max(1, CELLS // len(rows))
    for begin in range(0, len(rows), step):
        block = rows[begin : begin + step]
        i, j = np.nonzero(np.arange(begin, begin + len(block))[:, None] < np.arange(len(rows))[None, :])
        a, b = block[i], rows[j]
        for p in order:
            if len(a) < 512:
                break
            near = np.abs(table[a, p] - table[b, p]) <= radius
            if near.mean() > 0.9:  # a dense leaf: pivots no longer tell its rows apart
                break
            a, b = a[near], b[near]
        close = np.bitwise_count(bits[a] ^ bits[b]) <= radius
        _merge(labels, a[close], b[close])


def link_bucket(bits: np.ndarray, pivots: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of a bucket's distinct fingerprints, the position of its group's first member."""
    table = np.bitwise_count(bits[:, None] ^ pivots[None, :]).astype(np.int8)
    labels = np.arange(len(bits))
    todo = [labels.copy()]
    while todo:
        rows = todo.pop()
        if len(rows) > LEAF_ROWS:
            own = table[rows]
            widest = int(own.var(axis=0).argmax())
            distance = own[:, widest]
            middle = int(np.median(distance))
            near, far = rows[distance <= middle + radius - 1], rows[distance >= middle]
            if max(len(near), len(far)) <= 0.85 * len(rows):
                todo += [near, far]
                continue
        _compare(bits, table, rows, radius, labels)
    return labels


def links(classes: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``bits``) that connect all within ``radius``."""
    references = pivot_fingerprints(pivots)
    total = classes.count()
    # a split leaves about 0.6 of the rows on either side
    levels = 0 if total <= bucket_rows else min(pivots, int(np.ceil(np.log(total / bucket_rows) / -np.log(0.6))))
    codes = F.array(F.lit(0).cast("long"))
    if levels:
        literal = F.array(*[F.lit(int(p)) for p in references[:levels].astype(np.int64)])
        none = F.array().cast("array<long>")

        def deal(sofar, pivot):
            distance = F.bit_count(F.col("bits").bitwiseXOR(pivot))
            near = F.when(distance <= MIDDLE + radius - 1, F.transform(sofar, lambda c: c * 2)).otherwise(none)
            far = F.when(distance >= MIDDLE, F.transform(sofar, lambda c: c * 2 + 1)).otherwise(none)
            return F.concat(near, far)

        codes = F.aggregate(literal, codes, deal)

    def within(group: pa.Table) -> pa.Table:
        bits = np.sort(group.column("bits").to_numpy()).view(np.uint64)
        first = link_bucket(bits, references, radius)
        linked = np.nonzero(first != np.arange(len(bits)))[0]
        signed = bits.view(np.int64)
        return pa.table({"a": pa.array(signed[linked]), "b": pa.array(signed[first[linked]])})

    return (
        classes.select("bits", F.explode(codes).alias("code")).groupBy("code").applyInArrow(within, "a long, b long")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``): the smallest node it can reach.

    Each round every node moves to the neighbour that comes first in an order, if that comes
    before itself, then edges are named anew and those inside a group go. The order is drawn
    anew each round, so about half of the groups that still have an edge vanish, whatever
    names a chain has; the last in order always does, so the rounds end. Every round is
    written, so none is computed twice. No edges give no nodes.
    """
    left = written(edges.select("a", "b").where("a <> b").distinct(), "near-links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    groups = written(nodes.withColumn("label", F.col("node")), "near-labels")
    turn = 0
    while left.limit(1).count():

        def place(c: str) -> Column:
            # stars around their smallest node, the usual links, are done in the first round
            return F.struct(F.xxhash64(F.lit(turn), c) if turn else F.lit(0).cast("long"), F.col(c))

        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        moves = first.select("a", F.when(F.col("first") < place("a"), F.col("first")["b"]).otherwise(F.col("a")).alias("to"))
        moves = written(moves, "near-moves")
        further = moves.select(F.col("a").alias("to"), F.col("to").alias("end"))
        moves = written(moves.join(further, "to").select("a", "end"), "near-moves")
        ends = moves.withColumnsRenamed({"a": "b", "end": "b_end"})
        left = left.join(moves, "a").join(ends, "b").select(F.col("end").alias("a"), F.col("b_end").alias("b"))
        left = written(left.where("a <> b").distinct(), "near-links")
        groups = groups.join(moves.withColumnsRenamed({"a": "label"}), "label", "left")
        groups = written(groups.select("node", F.coalesce("end", "label").alias("label")), "near-labels")
        turn += 1
    smallest = groups.groupBy("label").agg(F.min("node").alias("smallest"))
    return groups.join(smallest, "label").select("node", F.col("smallest").alias("label"))


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` bits.
    Null and empty texts have fingerprint zero and are linked like any other; repeated
    rows share a component; null ids are never a component's id unless it has no other.
    An empty table gives an empty result; other columns are ignored.
    """
    prints = written(fingerprints(docs), "near-prints")
    classes = written(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "near-classes")
    labels = components(links(classes, radius))
    grouped = classes.join(labels.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "label", F.coalesce("label", "bits")
    )
    smallest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = grouped.join(smallest, "label").select("bits", "component_id")
    return prints.join(ids, "bits").select("doc_id", "fingerprint", "component_id")
