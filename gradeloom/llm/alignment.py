"""Token alignment across two tokenizers, on Arrow arrays.

Ids of a block are flat arrays with the parent index of every token. Token lengths summed
up within each parent give byte ends; a hash join on (document, end) finds where both end,
which cuts the tokens into groups. All tokens of a group are linked with each other.

How many documents hold an id pair linked is counted per block by Table.group_by; Spark adds
the blocks' counts up and brings them back to the blocks that hold the pair. A document
refers to its pairs by their numbers within its block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.blocks import block_ids, parts, ranges
from gradeloom.llm.common import slices, written
from gradeloom.llm.packing import word_ids

BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
#: Rows, and bytes of text, that are aligned at once.
SLICE_ROWS = 128
CACHE_WORDS = 400_000
#: Unseen words that are encoded as one text.
RUN_WORDS = 256
MARK = "▁"

#: Of a document, and of a block (``pairs`` not null, with the number of its documents that hold each).
BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, refs array<int>, times array<long>, pairs array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_SEGMENT = re.compile(" +[^ ]*")


class PieceIds:
    """Ids by a `sentencepiece` file; words are looked up.

    No piece holds the space mark behind another character, so no merge crosses the begin
    of a run of spaces: the segments ``spaces + word`` are encoded apart.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError(f"{path}: pieces cross spaces")
        self.opens = np.array([p.startswith(MARK) for p in self.pieces])
        self.known: dict[str, list[int]] = {}
        self.cache_words = cache_words

    def token_bytes(self) -> list[bytes]:
        out = []
        for i, p in enumerate(self.pieces):
            out.append(bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode())
        return out

    def _segments(self, segments: list[str]) -> dict[str, list[int]]:
        """Runs of words with one space before each are encoded as one text and cut where a word opens."""
        made = {}
        plain = {s: len(s) > 1 and s[1] != " " and MARK not in s for s in segments}
        single, alone = [s for s in segments if plain[s]], [s for s in segments if not plain[s]]
        runs = [single[k : k + RUN_WORDS] for k in range(0, len(single), RUN_WORDS)]
        for run, ids in zip(runs, self.model.encode(["".join(r)[1:] for r in runs], num_threads=1)):
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(run) or starts[0]:
                alone += run
                continue
            edges = [*starts.tolist(), len(ids)]
            for word, begin, end in zip(run, edges, edges[1:]):
                made[word] = ids[begin:end]
        for word, ids in zip(alone, self.model.encode([s[1:] for s in alone], num_threads=1)):
            made[word] = ids if len(word) > 1 else [self.model.piece_to_id(MARK)]
        return made

    def encode(self, spaced: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the space which the model puts before a text.

        A text that holds the mark itself, which the model takes for a space, is encoded whole.
        """
        found = [[t] if MARK in t else _SEGMENT.findall(t) for t in spaced]
        new = list(dict.fromkeys(s for segments in found for s in segments if s not in self.known))
        made = self._segments(new)
        if len(self.known) < self.cache_words:
            self.known.update((s, ids) for s, ids in made.items() if MARK not in s)
        look = self.known.get
        return [[i for s in segments for i in look(s) or made[s]] for segments in found]


@lru_cache(maxsize=1)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


@lru_cache(maxsize=1)
def byte_tokens(path: str) -> pa.Array:
    """Per id of a byte-level `tokenizers` file its bytes."""
    vocabulary = word_ids(path).tokenizer.get_vocab(with_added_tokens=True)
    # a byte that prints stands for itself; the others take the letters from U+0100 on, in order
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in prints}
    byte_of |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(prints))}
    out: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return pa.array(out, pa.binary())


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *values]), kind))


def _joined_equal(ids: pa.ListArray, tokens: pa.Array, texts: pa.Array) -> pa.Array:
    """Whether a document's token bytes, joined, are its text."""
    taken = pa.ListArray.from_arrays(ids.offsets, tokens.take(pc.list_flatten(ids)))
    return pc.equal(pc.binary_join(taken, pa.scalar(b"")), texts)


def _ends(ids: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """``doc, end, place`` of every token: the sum of lengths up to it within its document."""
    sums = pc.cumulative_sum(lengths.take(pc.list_flatten(ids)).cast(pa.int64()))
    doc = pc.list_parent_indices(ids).cast(pa.int64())
    before = pa.concat_arrays([pa.array([0], pa.int64()), sums]).take(ids.offsets.take(doc))
    return pa.table([doc, pc.subtract(sums, before), pa.array(np.arange(len(sums)))], names=["doc", "end", "place"])


def _texts_of(ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """Per group its ids, as decimal numbers with commas between."""
    offsets = pa.array(np.concatenate([[0], ends + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, ids.cast(pa.string())), ",")


def align(a: pa.ListArray, b: pa.ListArray, bytes_a: pa.Array, bytes_b: pa.Array) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
    """Figures per document, its groups as a text, and ``doc, pair, times`` of its linked id pairs.

    ``a`` and ``b`` are ids of the same bytes; documents without tokens have no groups. A pair
    is ``a * (number of B ids) + b``; a group answers with its distinct pairs, never with each
    pair of its tokens.
    """
    n = len(a)
    flat_a, flat_b = pc.list_flatten(a).cast(pa.int64()), pc.list_flatten(b).cast(pa.int64())
    own, other = _ends(a, pc.binary_length(bytes_a)), _ends(b, pc.binary_length(bytes_b))
    cuts = own.join(other, ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False).sort_by("place")
    end_a, end_b, doc = (cuts.column(c).to_numpy() for c in ("place", "place_b", "doc"))
    size_a, size_b = np.diff(end_a, prepend=-1), np.diff(end_b, prepend=-1)
    figures = {
        "n_a": np.diff(a.offsets.to_numpy()).astype(np.int64),
        "n_b": np.diff(b.offsets.to_numpy()).astype(np.int64),
        "n_groups": np.bincount(doc, minlength=n),
        "n_links": np.zeros(n, np.int64),
    }
    np.add.at(figures["n_links"], doc, size_a * size_b)

    groups = pc.binary_join_element_wise(_texts_of(flat_a, end_a), _texts_of(flat_b, end_b), "|")
    edges = np.concatenate([[0], np.cumsum(figures["n_groups"])])
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), groups), ";").to_pylist()

    ids_a, ids_b = flat_a.to_numpy(), flat_b.to_numpy()
    one = (size_a == 1) & (size_b == 1)
    pair = ids_a[end_a[one]] * len(bytes_b) + ids_b[end_b[one]]
    linked = [pa.table({"doc": doc[one], "pair": pair, "times": np.ones(len(pair), np.int64)})]
    if not one.all():
        many = np.flatnonzero(~one)
        sides = []
        for ids, ends, sizes in ((ids_a, end_a, size_a), (ids_b, end_b, size_b)):
            held = ids[ranges(ends[many] - sizes[many] + 1, ends[many] + 1)]
            side = pa.table({"group": np.repeat(many, sizes[many]), "id": held, "n": np.ones(len(held), np.int64)})
            sides.append(side.group_by(["group", "id"], use_threads=False).aggregate([("n", "sum")]))
        both = sides[0].join(sides[1], "group", join_type="inner", right_suffix="_b", use_threads=False)
        group, left, right, n_left, n_right = (both.column(c).to_numpy() for c in ("group", "id", "id_b", "n_sum", "n_sum_b"))
        linked.append(pa.table({"doc": doc[group], "pair": left * len(bytes_b) + right, "times": n_left * n_right}))
    pairs = pa.concat_tables(linked).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return figures, texts, pairs.rename_columns(["doc", "pair", "times"])


def _encoded(texts: pa.Array, path_a: str, path_b: str) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids of both tokenizers; none where the joined token bytes of one are not space + text."""
    spaced = [" " + t if t else "" for t in texts.to_pylist()]
    model_a, model_b = word_ids(path_a), piece_ids(path_b)
    a = _lists([np.frombuffer(ids, "<u4") for ids in model_a.encode(spaced)], pa.int32())
    b = _lists([np.array(ids, np.int64) for ids in model_b.encode(spaced)], pa.int32())
    raw = pa.array([t.encode() for t in spaced], pa.binary())
    whole = pc.and_(_joined_equal(a, byte_tokens(path_a), raw), _joined_equal(b, piece_tokens(path_b), raw))
    if not pc.all(whole).as_py():
        none = pa.array([], a.type.value_type)
        a, b = (
            _lists([(x.values if ok else none).to_numpy() for x, ok in zip(ids, whole.to_pylist())], pa.int32()) for ids in (a, b)
        )
    return a, b


@lru_cache(maxsize=1)
def piece_tokens(path: str) -> pa.Array:
    return pa.array(piece_ids(path).token_bytes(), pa.binary())


def _blocks(docs: DataFrame, path_a: str, path_b: str, rows: int, size: int) -> DataFrame:
    names = [f.split(" ")[0] for f in BLOCKS.split(", ")]
    types = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def batch(columns: dict, n: int) -> pa.RecordBatch:
        made = [columns.get(c) for c in names]
        return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else pa.array(c, t) if isinstance(c, (np.ndarray, list)) else c.cast(t) for c, t in zip(made, types)], names=names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_ids()
        block, held, counted = next(numbers), [], []
        for piece, last in parts(batches, rows, size):
            for part in slices(iter([piece]), SLICE_ROWS):
                a, b = _encoded(part.column("text"), path_a, path_b)
                figures, texts, pairs = align(a, b, byte_tokens(path_a), piece_tokens(path_b))
                sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
                held.append((part.column("doc_id").cast(pa.int64()), figures, sha, pairs))
                counted.append(pairs.group_by("pair", use_threads=False).aggregate([("doc", "count")]))
            if last:
                counts = pa.concat_tables(counted).group_by("pair", use_threads=False).aggregate([("doc_count", "sum")])
                counts = counts.sort_by("pair")
                known = counts.column("pair").to_numpy()
                yield batch({"block": [block], "pairs": _lists([known], pa.int64()), "times": _lists([counts.column("doc_count_sum").to_numpy()], pa.int64())}, 1)
                for ids, figures, sha, pairs in held:
                    doc, pair, times = (pairs.column(c).to_numpy() for c in ("doc", "pair", "times"))
                    order = np.lexsort((pair, doc))
                    edges = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ids)))])
                    lists = lambda v, t: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v[order], t))
                    refs, own = lists(np.searchsorted(known, pair), pa.int32()), lists(times, pa.int64())
                    yield batch({"block": np.full(len(ids), block), "doc_id": ids, **figures, "groups_sha256": sha, "refs": refs, "times": own}, len(ids))
                block, held, counted = next(numbers), [], []

    return docs.select("doc_id", "text").mapInArrow(measure, BLOCKS)


def align_documents(docs: DataFrame, path_a: str, path_b: str, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``) the figures of its alignment, see ``RESULT``.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros, and ``''`` for the hash. Repeated rows and rows without an id are documents of
    their own, in the counts too. An empty table gives an empty result; other columns are ignored.
    """
    n_b = len(piece_tokens(path_b))
    held = written(_blocks(docs, path_a, path_b, rows, size), "aligned-blocks")
    of_block = F.posexplode(F.arrays_zip("pairs", "times")).alias("ref", "own")
    pairs = held.where(F.col("pairs").isNotNull()).select("block", of_block)
    pairs = pairs.select("block", "ref", F.col("own.pairs").alias("pair"), F.col("own.times").alias("n"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("docs"))
    # an id of A has at most as many partners as B has ids
    of_a = Window.partitionBy(F.expr(f"pair div {n_b}"))
    counts = counts.withColumn("best", F.col("docs") == F.max("docs").over(of_a))
    found = pairs.join(counts, "pair").select(F.col("block").alias("home"), "ref", "docs", "best")

    def total(own: pa.Table, back: pa.Table) -> pa.Table:
        docs_of, best_of = np.zeros(back.num_rows, np.int64), np.zeros(back.num_rows, np.int64)
        ref = back.column("ref").to_numpy()
        docs_of[ref], best_of[ref] = back.column("docs").to_numpy(), back.column("best").cast(pa.int64()).to_numpy()
        refs, times = own.column("refs").combine_chunks(), own.column("times").combine_chunks()
        doc, flat = pc.list_parent_indices(refs).to_numpy(), pc.list_flatten(refs).to_numpy()
        n = pc.list_flatten(times).to_numpy()
        sums = {"n_best": np.zeros(own.num_rows, np.int64), "count_sum": np.zeros(own.num_rows, np.int64)}
        np.add.at(sums["n_best"], doc, n * best_of[flat])
        np.add.at(sums["count_sum"], doc, n * docs_of[flat])
        for name, values in sums.items():
            own = own.append_column(name, pa.array(values))
        return own.select([f.split(" ")[0] for f in RESULT.split(", ")])

    rows_of = held.where(F.col("pairs").isNull()).drop("pairs")
    return rows_of.groupBy("block").cogroup(found.groupBy("home")).applyInArrow(total, RESULT)
