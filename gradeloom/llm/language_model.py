"""Scores of whole documents by a recurrent language model that all training documents teach.

Words of a block are numbered within it; how often training documents hold them is added up
by Spark and brought back to the blocks. The most frequent words are ids of the model. All
others share a number of further ids by a hash, so the network learns from every word and
predicts the id of every word; the unigram counts of the whole corpus tell words of an id apart.

Training goes over all training documents in rounds. In a round every task learns from its
own documents, starting from the same parameters; the changes are averaged by Spark, weighted
by tokens. What the driver holds is one set of parameters, whatever the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import recurrent
from gradeloom.llm.blocks import BLOCK_BYTES, BLOCK_ROWS, block_ids, parts
from gradeloom.llm.common import slices, written

#: Words that are ids of the model, and ids that the others share. With the end fewer than 1 << 15.
MODEL_WORDS = 2047
OTHER_IDS = 1024
ROUNDS = 4
#: Words of a block that are given back at once.
WORD_ROWS = 1 << 16
#: Tokens that are strung on lanes at once.
CHUNK_TOKENS = 1 << 21
FOLDS, HELD_FOLD = 5, 1

#: A row is a document (``refs``: numbers of its words, 32 bits each) or a word of the block (``ref``: its number).
BLOCKS = "block long, doc_id long, held_out boolean, refs binary, ref int, word string, n long"
CODED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rest_score double, turn int, codes array<short>"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

Held = Callable[[int], bool]


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; one without an id is not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_FOLD


@dataclass
class Counts:
    """Training totals: tokens and distinct tokens with the ends, documents, and of the words outside the model by shared id."""

    tokens: int
    distinct: int
    docs: int
    rest_tokens: np.ndarray
    rest_distinct: np.ndarray

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def rest(self, c: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Of a word outside the model, given its shared id; all unseen words of an id share one place."""
        return np.log10((c + 0.5) / (self.rest_tokens[shared] + 0.5 * (self.rest_distinct[shared] + 1)))


@dataclass
class Model:
    """Ids of words, the ids that all other words share, and the network; id 0 ends a document."""

    counts: Counts
    ids: dict[str, int]
    others: np.ndarray
    shape: recurrent.Shape
    parameters: recurrent.Parameters

    @property
    def other(self) -> int:
        """The id of all other words where they share one."""
        (one,) = self.others.tolist()
        return one


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of texts, one after the other, and how many each has."""
    # on bytes: A-Z only, and exactly the six ASCII spaces
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    lists = pc.ascii_split_whitespace(bare)
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)
    if blank.any():  # split into one empty string
        n[blank] = 0
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, n


def _packed(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """Runs of ``n`` integers as binary values: Spark carries them as they are, not one by one."""
    edges = pa.array(values.itemsize * np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(n), [None, edges.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def _runs(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Integers of lists or of packed values, and where each run begins, with the end of the last."""
    if not pa.types.is_binary(column.type):
        return column.values.to_numpy(), column.offsets.to_numpy()
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[: edges[-1]] if data else np.empty(0, np.uint8)
    return flat.view(kind), edges // flat.view(kind).itemsize


def numbered(docs: DataFrame, held: Held = held_out, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """Documents as numbers of their block's words, and the words of every block with their training counts."""
    names = [f.split(" ")[0] for f in BLOCKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.string(), pa.int64()]

    def rows_of(block: int, rows: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(rows, block, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, t)) for c, t in zip(names, types)], names=names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_ids()
        ids, found, lengths = [], [], []
        for piece, last in parts(batches, rows, size):
            for part in slices(iter([piece])):
                words, n = split(part.column("text"))
                ids.append(part.column("doc_id").cast(pa.int64()))
                found.append(words)
                lengths.append(n)
            if not last:
                continue
            coded = pa.concat_arrays(found).dictionary_encode()
            n, doc_ids = np.concatenate(lengths), pa.concat_arrays(ids)
            out = np.array([held(i) for i in doc_ids.to_pylist()], bool)
            counts = np.bincount(coded.indices.to_numpy()[~np.repeat(out, n)], minlength=len(coded.dictionary))
            block = next(numbers)
            words = coded.dictionary.cast(pa.binary()).cast(pa.string())  # checks the UTF-8
            ref = pa.array(np.arange(len(words), dtype=np.int32))
            yield from slices(iter([rows_of(block, len(words), ref=ref, word=words, n=pa.array(counts, pa.int64()))]), WORD_ROWS)
            own = rows_of(block, len(n), doc_id=doc_ids, held_out=pa.array(out), refs=_packed(coded.indices.to_numpy(), n))
            yield from slices(iter([own]))
            ids, found, lengths = [], [], []

    return written(docs.select("doc_id", "text").mapInArrow(number, BLOCKS), "lm-blocks", compression="zstd")


def resolved(blocks: DataFrame, model_words: int, rounds: int, other_ids: int = 1, packed: bool = False) -> tuple[DataFrame, Model]:
    """Documents as ids of a new, untrained model, with all that corpus counts say of them.

    ``packed``: the ids of a document as bytes, 16 bits each, and not as an array.
    """
    spark = blocks.sparkSession
    own = blocks.where(F.col("word").isNotNull()).select("block", "ref", "word", "n")
    counts = written(own.groupBy("word").agg(F.sum("n").alias("count")), "lm-counts")
    docs = blocks.where(~F.col("held_out")).count()
    # bounded: at most model_words rows
    top = counts.where("count > 0").orderBy(F.desc("count"), "word").limit(model_words).collect()
    # bounded: at most other_ids rows
    shared = (F.crc32(F.col("word").cast("binary")) % other_ids).cast("int")
    rest = np.zeros((other_ids, 2), np.int64)
    for k, n, seen in counts.groupBy(shared).agg(F.sum("count"), F.count_if(F.col("count") > 0)).collect():
        rest[k] = n, seen
    words, distinct = rest.sum(axis=0).tolist()
    for r in top:
        rest[zlib.crc32(r["word"].encode()) % other_ids] -= (r["count"], 1)
    totals = Counts(words + docs, distinct + (docs > 0), docs, rest[:, 0], rest[:, 1])

    by_count = sorted([*((-n, "", k) for k, n in enumerate(rest[:, 0].tolist())), *((-r["count"], r["word"], -1) for r in top)])
    ids = {word: i for i, (_, word, k) in enumerate(by_count, 1) if k < 0}
    others = np.array([i for _, i in sorted((k, i) for i, (_, _, k) in enumerate(by_count, 1) if k >= 0)], np.int16)
    masses = np.array([docs, *(-n for n, _, _ in by_count)], float) + 0.5
    shape = recurrent.Shape(recurrent.class_edges(masses))
    model = Model(totals, ids, others, shape, recurrent.start(shape, masses))

    known = spark.createDataFrame(pa.table({"word": pa.array(ids.keys(), pa.string()), "id": pa.array(ids.values(), pa.int32())}))
    # no sort of the words: of a partition only its distinct ones are held, and no word is more than one of them
    found = own.drop("n").join(counts.hint("shuffle_hash"), "word").join(F.broadcast(known), "word", "left")
    # words outside the model: their shared id from behind, from -1
    found = found.select(F.col("block").alias("home"), "ref", "count", F.coalesce("id", -1 - shared).alias("id"))
    schema = CODED.replace("array<short>", "binary") if packed else CODED
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def code(own: pa.Table, back: pa.Table) -> pa.Table:
        ref = back.column("ref").to_numpy()
        count, of = np.zeros(len(ref), np.int64), np.zeros(len(ref), np.int64)
        count[ref], of[ref] = back.column("count").to_numpy(), back.column("id").to_numpy()
        outside, base, rest = of < 0, totals.base(count), np.zeros(len(ref))
        shared = -1 - of[outside]
        rest[outside] = totals.rest(count[outside], shared)
        of[outside] = others[shared]
        flat, edges = _runs(pa.concat_arrays(own.column("refs").chunks), np.int32)
        flat, n = flat[edges[0] :], np.diff(edges).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        sums = lambda v: np.bincount(doc, v[flat], len(n)).astype(float)
        ids = of.astype(np.int16)[flat]
        columns = [
            own.column("doc_id"),
            own.column("held_out"),
            pa.array(n + 1),
            pa.array(sums((count > 0).astype(float)).astype(np.int64) + (docs > 0)),
            pa.array(sums(base) + float(totals.base(np.array(docs)))),
            pa.array(sums(rest)),
            pa.array((np.arange(len(n)) % rounds).astype(np.int32)),
            _packed(ids, n) if packed else pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids)),
        ]
        return pa.table(columns, names=names)

    rows = blocks.where(F.col("refs").isNotNull()).select("block", "doc_id", "held_out", "refs")
    return written(rows.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(code, schema), "lm-coded", compression="zstd"), model


def _chunks(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Rows and their ids, together about ``tokens`` of them."""
    held, docs, n = [], [], 0
    for batch in slices(batches):
        flat, edges = _runs(batch.column("codes"), np.int16)
        held.append(batch)
        docs += [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        n += int(edges[-1] - edges[0])
        if n >= tokens:
            yield held, docs
            held, docs, n = [], [], 0
    if docs:
        yield held, docs


def trained(coded: DataFrame, model: Model, rounds: int = ROUNDS, chunk: int = CHUNK_TOKENS) -> Model:
    """The model after every training document has been learnt from once."""
    shape, now = model.shape, recurrent.flat(model.parameters).astype(np.float64)
    for turn in range(rounds):
        sent = coded.sparkSession.sparkContext.broadcast(now.astype(np.float32))  # the size of the model

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            learner = None
            for _, docs in _chunks(batches, chunk):
                learner = learner or recurrent.Learner(recurrent.unflat(sent.value, shape), shape)
                learner.learn(docs)
            if learner:
                change = recurrent.flat(learner.p).astype(np.float64) - sent.value
                moved = np.flatnonzero(change)
                place = np.append(moved, -1)  # the last row carries the weight of all
                columns = [pa.array(place), pa.array(np.append(change[moved] * learner.n_tokens, learner.n_tokens))]
                yield pa.RecordBatch.from_arrays(columns, names=["place", "change"])

        lessons = coded.where(~F.col("held_out") & (F.col("turn") == turn)).select("codes")
        summed = lessons.mapInArrow(learn, "place long, change double").groupBy("place").agg(F.sum("change").alias("change"))
        made = summed.toArrow()  # at most a row per parameter
        place, change = made.column("place").to_numpy(), made.column("change").to_numpy()
        weight = change[place < 0].sum()
        if weight:
            now[place[place >= 0]] += change[place >= 0] / weight
        sent.unpersist()
    return Model(model.counts, model.ids, model.others, shape, recurrent.unflat(now, shape))


def scored(coded: DataFrame, model: Model, chunk: int = CHUNK_TOKENS) -> DataFrame:
    """Every document's figures with the log10 probability of its whole text under the model."""
    sent = coded.sparkSession.sparkContext.broadcast(recurrent.flat(model.parameters))  # the size of the model
    shape = model.shape

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters = recurrent.unflat(sent.value, shape)
        for held, docs in _chunks(batches, chunk):
            found = recurrent.document_scores(docs, parameters, shape) / math.log(10)
            rows = pa.Table.from_batches(held).drop_columns(["codes", "turn"]).append_column("score", pa.array(found))
            yield from rows.to_batches()

    out = coded.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rest_score double, score double")
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.counts.tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("score") + F.col("rest_score")).alias("score"),
    )


def score_documents(
    docs: DataFrame, model_words: int = MODEL_WORDS, rounds: int = ROUNDS, held: Held = held_out, other_ids: int = OTHER_IDS
) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``) its scores, see ``RESULT``; learnt from the rows that are not held out.

    Null and empty texts hold the end alone. Repeated rows count and are scored each; a row
    without an id is learnt from. Without training documents all counts are 0 and the model is
    the untrained one. An empty table gives an empty result; other columns are ignored.
    """
    coded, model = resolved(numbered(docs, held), model_words, rounds, other_ids, packed=True)
    return scored(coded, trained(coded, model, rounds))
