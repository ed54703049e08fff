"""BERTScore: greedy cosine matching of prediction tokens with reference tokens.

Vectors per token come from a given table. Pairs are written as numbers of their tokens, in
blocks; a task takes the pairs of many blocks and each distinct vector of theirs once. A pair's
similarities are a matrix product, taken in parts over the distinct tokens of either side;
token pairs are never emitted as rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.overlap import encoded_tokens, one_dictionary, row_slices, text_bytes
from gradeloom.functions.text import Splitter, tokenizer_named
from gradeloom.operators.quality import f_measure
from gradeloom.session import written

BLOCK = 2048
# Text bytes of a block of pairs and of a piece of it, tokens in a row of a block's vocabulary.
BLOCK_BYTES = 192 << 20
PIECE_BYTES = 4 << 20
LISTED_TOKENS = 1 << 16
# Tokens of all blocks that are packed together.
PACKED_TOKENS = 1 << 20
# Fewest groups of blocks where there is a choice, bytes of the vectors that a group holds, and tasks over the groups.
LEAST_GROUPS = 12
GROUP_VECTOR_BYTES = 256 << 20
MOST_TASKS = 20_000
# What a row of a group is, in the order a task meets them.
VECTOR, TOKEN, PAIRS = 0, 1, 2


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1.0)


def best_matches(of: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Highest similarity of each row of ``of`` with a row of ``among``; rows are unit vectors."""
    best = np.full(len(of), -np.inf)
    for i in range(0, len(of), BLOCK):
        for j in range(0, len(among), BLOCK):
            similarity = of[i:i + BLOCK] @ among[j:j + BLOCK].T
            np.maximum(best[i:i + BLOCK], similarity.max(axis=1), out=best[i:i + BLOCK])
    return best


def _mean_best(vectors: np.ndarray, ids: np.ndarray, counts: np.ndarray, others: np.ndarray, self_match: np.ndarray, marks: np.ndarray) -> float:
    """Weighted mean of the best matches; a vector that both sides have is its own best match.

    ``marks`` are false for every vector, before and after.
    """
    marks[others] = True
    common = marks[ids]
    marks[others] = False
    best = np.where(common, self_match[ids], 0.0)
    if not common.all():
        best[~common] = best_matches(vectors[ids[~common]], vectors[others])
    return float(best @ counts / counts.sum())


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of four bytes; like bytes of the numbers lie side by side, most of them zero."""
    header = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = [np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays]
    plain = header + b"".join(planes)
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd").compress(plain, asbytes=True)


def _unsqueezed(data: bytes, count: int) -> list[np.ndarray]:
    plain = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    at, out = 8 * count, []
    for n in np.frombuffer(plain, np.int64, count).tolist():
        planes = np.frombuffer(plain, np.uint8, 4 * n, at).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))
        at += 4 * n
    return out


class _Piece:
    """A few pairs: the kept columns, each distinct text's distinct tokens with their counts, the texts of every pair."""

    def __init__(self, batch: pa.RecordBatch, columns: list[str], splitter: Splitter):
        kept = batch.select(columns)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(kept)
        self.kept = sink.getvalue()
        # a reference has a prediction of every model, and is split once
        texts = pa.chunked_array([pc.fill_null(batch.column(c), "").cast(pa.large_string()) for c in ("_p", "_r")])
        texts = texts.combine_chunks().dictionary_encode()
        self.which = texts.indices.to_numpy(zero_copy_only=False)
        tokens, lengths = encoded_tokens(texts.dictionary, splitter)
        codes, self.words = one_dictionary(tokens)
        size = max(len(self.words), 1)
        found, counts = np.unique(np.repeat(np.arange(len(lengths), dtype=np.int64), lengths) * size + codes, return_counts=True)
        self.sizes = np.bincount(found // size, minlength=len(lengths))
        self.codes, self.counts = (found % size).astype(np.int32), counts.astype(np.int32)

    def packed(self, numbers: np.ndarray) -> bytes:
        """``numbers`` are the words' codes in the block; of a text's codes, in order, the steps are kept."""
        codes = numbers[self.codes].astype(np.int64)
        order = np.argsort((np.repeat(np.arange(len(self.sizes)), self.sizes) << 32) + codes)
        codes = codes[order]
        steps = np.diff(codes, prepend=0)
        heads = np.cumsum(self.sizes) - self.sizes
        heads = heads[self.sizes > 0]
        steps[heads] = codes[heads]
        return _squeezed(self.which, self.sizes, steps, self.counts[order])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text of every prediction and then of every reference, the texts' ends, their codes and counts."""
    which, sizes, steps, counts = _unsqueezed(data, 4)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.cumsum(steps)
    before = np.concatenate([[0], sums])[ends[:-1]]
    return which, ends, sums - np.repeat(before, sizes), counts


BLOCKS = T.StructType([
    T.StructField("_block", T.LongType()), T.StructField("_kept", T.BinaryType()), T.StructField("_numbers", T.BinaryType()),
    T.StructField("_first", T.IntegerType()), T.StructField("_tokens", T.ArrayType(T.StringType())),
])


def _numbering(splitter: Splitter, columns: list[str], block_bytes: int):
    """Consecutive pairs as numbers of their block's tokens, piece by piece, and per block rows of its tokens."""

    def closed(block: int, pieces: list[_Piece]) -> Iterator[pa.RecordBatch]:
        listed = [pa.DictionaryArray.from_arrays(pa.array(np.arange(len(x.words), dtype=np.int32)), x.words) for x in pieces]
        numbers, words = one_dictionary(listed)
        ends = np.cumsum([0, *(len(x.words) for x in pieces)]).tolist()
        for a, b, piece in zip(ends, ends[1:], pieces):
            yield row([block], [piece.kept.to_pybytes()], [piece.packed(numbers[a:b])], [None], [None])
        for a in range(0, len(words), LISTED_TOKENS):
            some = words.slice(a, LISTED_TOKENS).cast(pa.string())
            yield row([block], [None], [None], [a], pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some))

    def row(*values) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(values, kinds)], names=BLOCKS.names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)  # no other task's, the same when a task is run again
        pieces: list[_Piece] = []
        used = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = text_bytes(batch.column("_p")) + text_bytes(batch.column("_r"))
            for a, b in row_slices(sizes, min(PIECE_BYTES, block_bytes)):
                size = int(sizes[a:b].sum())
                if used and used + size > block_bytes:
                    yield from closed(next(numbers), pieces)
                    pieces, used = [], 0
                    pa.default_memory_pool().release_unused()
                pieces.append(_Piece(batch.slice(a, b - a), columns, splitter))
                used += size
        if pieces:
            yield from closed(next(numbers), pieces)

    return number


# A vector is carried as the bytes of its numbers: Spark measures a batch of lists anew with every row.
NUMBERED = T.StructType([
    T.StructField("token", T.StringType()), T.StructField("_vec", T.LongType()), T.StructField("vec", T.BinaryType()),
])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers for runs of equal vectors; the vector itself stays at the first row of its run only."""
    run = (TaskContext.get().partitionId() << 32) - 1  # no other task's
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        vecs = batch.column("vec")
        rows = vecs.flatten().to_numpy(zero_copy_only=False).reshape(len(vecs), -1)
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        new[0] = last is None or len(last) != rows.shape[1] or bool((last != rows[0]).any())
        last = rows[-1].copy()
        numbers = run + np.cumsum(new)
        run = int(numbers[-1])
        heads = pa.array([row.tobytes() if first else None for row, first in zip(rows, new.tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("token"), pa.array(numbers), heads], names=NUMBERED.names)


ASKED = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_numbers", T.BinaryType())])


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's tokens and the numbers of their vectors, many in a row."""

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ref, vec = (np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in ("_block", "_ref", "_vec"))
        order = np.lexsort((ref, block))
        block, ref, vec = block[order], ref[order], vec[order]
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for a, b in zip(edges, edges[1:]):
            data = _squeezed(np.diff(ref[a:b], prepend=0), vec[a:b] & 0xFFFFFFFF, vec[a:b] >> 32)
            yield pa.RecordBatch.from_arrays([pa.array(block[a:a + 1]), pa.array([data], pa.binary())], names=ASKED.names)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) >= PACKED_TOKENS:
            yield from packed(held)
            held = []
    if held:
        yield from packed(held)


def _asked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a block, and for each the number of a vector."""
    steps, low, high = _unsqueezed(data, 3)
    return np.cumsum(steps), (high << 32) | low


def _vectors_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group, data in zip(batch.column("_group").to_pylist(), batch.column("_numbers").to_pylist()):
            found = np.unique(_asked(data)[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), group, np.int64)), pa.array(found)], names=["_group", "_vec"])


class _Vectors:
    """The distinct vectors of a group by their numbers, and of the block at hand the vector of every token."""

    def __init__(self, most: int, kind: str):
        self.most, self.kind, self.n = most, kind, 0
        self.rows: np.ndarray | None = None
        self.numbers, self.norms = np.zeros(most, np.int64), np.zeros(most)
        self.slots = np.zeros(0, np.int64)
        self.asked: list[tuple[np.ndarray, np.ndarray]] = []
        self.order: np.ndarray | None = None

    def add(self, numbers: np.ndarray, vecs: pa.BinaryArray) -> None:
        rows = np.frombuffer(b"".join(vecs.to_pylist()), self.kind).reshape(len(vecs), -1)
        if self.rows is None:  # touched only as far as it is filled
            self.rows = np.empty((self.most, rows.shape[1]), rows.dtype)
        at = slice(self.n, self.n + len(rows))
        self.rows[at], self.numbers[at] = rows, numbers
        self.norms[at] = np.linalg.norm(rows.astype(np.float64), axis=1)
        self.n += len(rows)

    def ask(self, data: bytes) -> None:
        self.asked.append(_asked(data))

    def new_block(self) -> None:
        self.slots, self.asked = np.zeros(0, np.int64), []

    def slots_of(self, codes: np.ndarray) -> np.ndarray:
        """The place of every token's vector, -1 where it has none.

        A token listed with more than one vector counts with the smallest of these.
        """
        if self.asked:
            refs, numbers = (np.concatenate(parts) for parts in zip(*self.asked))
            if self.order is None:
                self.order = np.argsort(self.numbers[:self.n])
            slot = self.order[np.searchsorted(self.numbers[:self.n], numbers, sorter=self.order)]
            self.slots = np.full(int(refs.max()) + 1, -1, np.int64)
            self.slots[refs] = slot
            if np.count_nonzero(self.slots >= 0) < len(refs):
                for k, at in zip(refs.tolist(), slot.tolist()):
                    if tuple(self.rows[at]) < tuple(self.rows[self.slots[k]]):
                        self.slots[k] = at
            self.asked = []
        out = np.full(len(codes), -1, np.int64)
        listed = codes < len(self.slots)
        out[listed] = self.slots[codes[listed]]
        return out

    def scored(self, kept: bytes, numbers: bytes) -> pa.RecordBatch:
        """A piece's kept columns with precision and recall of every pair."""
        pairs = pa.ipc.open_stream(kept).read_all().combine_chunks()
        n = pairs.num_rows
        which, ends, codes, counts = _unpacked(numbers)
        at = self.slots_of(codes)
        own, place = np.unique(at, return_inverse=True)
        shift = int(len(own) > 0 and own[0] < 0)  # tokens without a vector come first
        own, place = own[shift:], place - shift
        units = self.rows[own].astype(np.float64) if len(own) else np.zeros((0, 1))
        norms = self.norms[own]
        units /= np.where(norms > 0, norms, 1.0)[:, None]
        self_match = (units * units).sum(axis=1)
        sides: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def vectors_of(text: int) -> tuple[np.ndarray, np.ndarray]:
            """Distinct vectors of one text, and how many of its tokens have each."""
            if text not in sides:
                here, weights = place[ends[text]:ends[text + 1]], counts[ends[text]:ends[text + 1]]
                found, index = np.unique(here[here >= 0], return_inverse=True)
                sides[text] = found, np.bincount(index, weights[here >= 0], len(found))
            return sides[text]

        precision, recall, marks = np.zeros(n), np.zeros(n), np.zeros(len(own), bool)
        for i in range(n):
            (p_id, p_n), (r_id, r_n) = vectors_of(int(which[i])), vectors_of(int(which[n + i]))
            if len(p_id) and len(r_id):
                precision[i] = _mean_best(units, p_id, p_n, r_id, self_match, marks)
                recall[i] = _mean_best(units, r_id, r_n, p_id, self_match, marks)
        columns = [column.chunk(0) if column.num_chunks else pa.nulls(0, column.type) for column in pairs.columns]
        return pa.RecordBatch.from_arrays([*columns, pa.array(precision), pa.array(recall)], names=[*pairs.column_names, "_precision", "_recall"])


def _group_matcher(most: int, kind: str):
    """Matches the pairs of groups, whose vectors come first, then block by block the tokens and the pairs."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = block = None  # of the rows at hand
        vectors = _Vectors(most, kind)
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_group", "_block", "_kind")]
            if not batch.num_rows:
                continue
            changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            for a, b in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
                g, at, what = (int(k[a]) for k in keys)
                if g != group:
                    group, block, vectors = g, None, _Vectors(most, kind)
                if at != block:
                    block = at
                    vectors.new_block()
                rows = batch.slice(a, b - a)
                if what == VECTOR:
                    vectors.add(rows.column("_vec").to_numpy(zero_copy_only=False), rows.column("vec"))
                    continue
                for k in range(rows.num_rows):
                    data = rows.column("_numbers")[k].as_py()
                    if what == TOKEN:
                        vectors.ask(data)
                    else:
                        yield vectors.scored(rows.column("_kept")[k].as_py(), data)

    return match


def match_tokens(
    pairs: DataFrame, vectors: DataFrame, tokenizer: str = "whitespace", block_bytes: int = BLOCK_BYTES,
    kept: Sequence[str] | None = None,
) -> DataFrame:
    """Pairs plus BERTScore precision, recall and F1 over a ``(token, vec)`` table.

    No idf weights and no baseline rescaling. Tokens without a vector are left out;
    of several vectors of a token the smallest counts. Rows may repeat. ``kept`` are the
    columns of ``pairs`` to return, all by default; the texts need not be among them.

    Blocks are consecutive pairs of about ``block_bytes`` of text, each block within a task.
    Each distinct text of a piece is split once and written as numbers of the block's distinct
    tokens, with the kept columns. The tokens of a block ask for the numbers of their vectors.
    Blocks of some tasks form a group, which gets each distinct vector once, however many
    tokens share it; a task has a group's vectors at hand and its pairs pass by. There are
    several groups a core, but no more than move about as many bytes of vectors as of pairs;
    where all vectors are too many for a task, each block is a group.
    """
    rule = tokenizer_named(tokenizer)
    spark = pairs.sparkSession
    columns = [c for c in pairs.columns if kept is None or c in kept]
    fields = [f for f in pairs.schema.fields if f.name in columns]
    prepared = pairs.select(*columns, rule.prepare(F.col("prediction")).alias("_p"), rule.prepare(F.col("reference")).alias("_r"))
    blocks = written(prepared.mapInArrow(_numbering(rule.splitter, columns, block_bytes), BLOCKS), "match-blocks", compression="zstd")

    # equal vectors lie side by side, so a vector is written once a task; the hash only brings them together
    single = vectors.schema["vec"].dataType == T.ArrayType(T.FloatType())
    listed = vectors.where("vec IS NOT NULL").select("token", F.col("vec") if single else F.col("vec").cast("array<double>").alias("vec"))
    runs = listed.withColumn("_hash", F.xxhash64("vec")).sortWithinPartitions("_hash").drop("_hash").mapInArrow(_runs, NUMBERED)
    numbered = written(runs, "match-vectors", compression="zstd")
    asked = blocks.where("_tokens IS NOT NULL").select("_block", "_first", F.posexplode("_tokens").alias("_at", "token"))
    known = asked.join(numbered.select("token", "_vec"), "token")
    known = known.select("_block", (F.col("_first") + F.col("_at")).alias("_ref"), "_vec").mapInArrow(_by_block, ASKED)
    known = written(known, "match-tokens", compression="zstd")

    own = blocks.where("_numbers IS NOT NULL").select("_block", "_kept", "_numbers")
    heads = numbered.where("vec IS NOT NULL").select("_vec", "vec")
    most, vector_bytes = heads.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("vec")), F.lit(0))).first()
    packed, number_of_blocks = own.agg(F.coalesce(F.sum(F.length("_numbers")), F.lit(0)), F.count_distinct("_block")).first()
    if vector_bytes <= GROUP_VECTOR_BYTES:
        groups = min(4 * spark.sparkContext.defaultParallelism, max(LEAST_GROUPS, packed // max(vector_bytes, 1)))
        group = F.pmod(F.shiftright("_block", 32), F.lit(groups)).cast("long")
    else:
        groups, group = min(max(1, number_of_blocks), MOST_TASKS), F.col("_block")

    wanted = known.select(group.alias("_group"), "_numbers").mapInArrow(_vectors_asked, "_group BIGINT, _vec BIGINT").distinct()
    rows = [
        wanted.join(heads, "_vec").select("_group", F.lit(-1).cast("long").alias("_block"), F.lit(VECTOR).alias("_kind"), "_vec", "vec"),
        known.select(group.alias("_group"), "_block", F.lit(TOKEN).alias("_kind"), "_numbers"),
        own.select(group.alias("_group"), "_block", F.lit(PAIRS).alias("_kind"), "_numbers", "_kept"),
    ]
    together = rows[0].unionByName(rows[1], True).unionByName(rows[2], True)
    if vector_bytes <= GROUP_VECTOR_BYTES:
        dealt = together.repartitionById(groups, F.col("_group").cast("int"))
    else:
        dealt = together.repartition(groups, "_group")
    schema = T.StructType([*fields, T.StructField("_precision", T.DoubleType()), T.StructField("_recall", T.DoubleType())])
    matched = dealt.sortWithinPartitions("_group", "_block", "_kind").mapInArrow(_group_matcher(most, "<f4" if single else "<f8"), schema)
    p, r = F.col("_precision"), F.col("_recall")
    return matched.withColumns(
        {"bertscore_precision": p, "bertscore_recall": r, "bertscore_f1": f_measure(p, r)}
    ).drop("_precision", "_recall")
