"""Best-fit packing of token sequences, planned on the histogram of their lengths.

The plan needs only how many pieces there are of each length (at most ``capacity``
numbers). It places counts, longest first, into the fullest sequences they fit, and
says which ranks within a length go to which run of sequences at which offset. Pieces
then find their slot by joining on their rank within their length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import slices, written

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 400_000
#: Unseen words that are encoded as one text.
RUN_WORDS = 512
#: A space, and the letter that stands for it in byte-level vocabularies.
SPACES = " \u0120"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


class WordIds:
    """Ids of texts by a `tokenizers` file, as bytes; words that recur are looked up.

    The vocabulary's own pattern always cuts before a space, unless white space stands both
    before it and after it. Texts without such a space are looked up part by part, each
    part beginning with its space; others are encoded whole.
    """

    def __init__(self, tokenizer_path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.cache_words = cache_words
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose bytes begin with a space
        self.opens[[i for token, i in vocabulary.items() if token[0] in SPACES]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", c.ids).tobytes() for c in coded]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it.

        Words without white space at their ends are encoded a run at a time: the pattern cuts
        before every space, so each id that opens with a space begins the next word. A run
        in which these are not as many as its words is encoded word by word.
        """
        out: list[bytes] = [b""] * len(words)
        plain = [i for i, w in enumerate(words) if w and not (w[0].isspace() or w[-1].isspace())]
        alone = [i for i, w in enumerate(words) if not w or w[0].isspace() or w[-1].isspace()]
        runs = [plain[k : k + RUN_WORDS] for k in range(0, len(plain), RUN_WORDS)]
        for run, ids in zip(runs, self._encode([" " + " ".join([words[i] for i in run]) for run in runs])):
            starts = np.flatnonzero(self.opens[np.frombuffer(ids, "<u4")])
            if len(starts) != len(run) or starts[0]:
                alone += run
                continue
            edges = [*(4 * starts).tolist(), len(ids)]
            for i, begin, end in zip(run, edges, edges[1:]):
                out[i] = ids[begin:end]
        for i, ids in zip(alone, self._encode([" " + words[i] for i in alone])):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        found: list[list[bytes | None]] = []
        missing: list[tuple[int, list[int], list[str]]] = []
        whole: list[int] = []
        new: dict[str, bytes] = {}
        look = self.known.get  # by the word behind a space
        for k, text in enumerate(texts):
            if _INSIDE_RUN.search(text):
                whole.append(k)
                found.append([])
                continue
            words = text.split(" ")
            ids = list(map(look, words))
            ids[0] = None  # no space before the first
            gaps = [i for i, got in enumerate(ids) if got is None]
            for i in gaps[1:]:
                new[words[i]] = b""
            missing.append((k, gaps, words))
            found.append(ids)
        begin = self._encode([words[0] for _, _, words in missing])
        new = dict(zip(new, self._encode_words(list(new))))
        for first, (k, gaps, words) in zip(begin, missing):
            ids = found[k]
            ids[0] = first
            for i in gaps[1:]:
                ids[i] = new[words[i]]
        for k, ids in zip(whole, self._encode([texts[k] for k in whole])):
            found[k] = [ids]
        if len(self.known) < self.cache_words:
            self.known.update(new)
        return list(map(b"".join, found))


@lru_cache(maxsize=1)
def word_ids(tokenizer_path: str) -> WordIds:
    """One per Python worker, so that the tasks it runs in turn share what is known."""
    return WordIds(tokenizer_path)


#: A space whose cut would part a run of white space that the pattern takes whole.
_INSIDE_RUN = re.compile(r"\s (?=\s|\Z)")


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full ones, after a first that may be shorter."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n_tokens, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document; ``place`` counts those of the same length in the same task (``part``)."""
    ending = np.array([END_ID], "<u4").tobytes()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for rows in slices(batches):
            out = []
            for doc_id, ids in zip(rows.column(0).to_pylist(), words.encode([t or "" for t in rows.column(1).to_pylist()])):
                ids += ending
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out.append((doc_id, k, start, length, crc, part, seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=[c.split()[0] for c in PIECES.split(", ")]
            )

    return docs.select("doc_id", "text").mapInArrow(measure, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts: rows ``(length, first_rank, end_rank, first_sequence, offset)``.

    Ranks ``first_rank`` up to ``end_rank`` of a length go to consecutive sequences from
    ``first_sequence`` on, each at ``offset``. The number of rows depends on the number
    of lengths only, never on the counts.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room left: runs (first sequence, sequences)
    rooms: list[int] = []  # with runs, in order
    opened = 0

    def give(room: int, run: tuple[int, int]) -> None:
        if room and run[1]:
            if not free[room]:
                insort(rooms, room)
            free[room].append(run)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            else:
                room, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            # a sequence that has just taken one is the best fit for the next: fill it before the one behind it
            each = room // length
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            for run, sequences, layers in ((first, full, each), (first + full, min(rest, 1), rest)):
                for layer in range(layers if sequences else 0):
                    rows.append((length, rank, rank + sequences, run, capacity - room + layer * length))
                    rank += sequences
                give(room - layers * length, (run, sequences))
            begun = full + min(rest, 1)
            give(room, (first + begun, many - begun))
            left -= full * each + rest
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    A null or empty text is a single piece holding the end id. Repeated rows are packed
    once each. An empty table gives an empty result; other columns are ignored.
    """
    cut_up = written(pieces(docs, tokenizer_path, capacity), "packing-pieces")
    by_part = cut_up.groupBy("part", "length").agg(F.count("*").alias("many"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(by_part.withColumn("before", F.coalesce(F.sum("many").over(before), F.lit(0))), "packing-offsets")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["many"] for r in offsets.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    slots = docs.sparkSession.createDataFrame(
        plan(histogram, capacity), "length long, first_rank long, end_rank long, first_sequence long, offset long"
    )
    ranked = cut_up.join(offsets.drop("many"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    taken = (ranked["rank"] >= slots["first_rank"]) & (ranked["rank"] < slots["end_rank"])
    return (
        ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & taken)
        .select(
            "doc_id",
            "piece",
            "start",
            ranked["length"],
            "ids_crc32",
            (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
            "offset",
        )
    )
