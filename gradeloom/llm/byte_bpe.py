"""Byte-level BPE in Spark expressions: a fold of ranked merges over the bytes of distinct words.

Tokens are characters here: the token of rank r is the character with code point r (rank 0,
a single byte in such vocabularies, has a stand-in), so a word in progress is a short string, its tokens' order is the order of ranks, and a merge is
a native string replacement. A word starts as the characters of its bytes. Each step of the
fold looks up all neighbouring pairs in the rank map, takes the smallest result, and
replaces that pair throughout; it ends when no pair is in the map.

The rank map is a literal: an array of buckets by checksum, each a string of entries
``mark, left, right, merged``. Words are counted over the whole corpus; the most frequent
distinct ones are encoded once by that expression and sent to the tasks, with a documented
number of entries. Spark splits all texts; a task takes the distinct words of a piece of its
texts, looks up the common ones, and folds the bytes of the others all at once, by the same
merges over arrays of ids. Nothing but word counts is shuffled.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.llm.blocks import ranges
from gradeloom.llm.common import written

#: Distinct words that are encoded ahead of the corpus.
COMMON_WORDS = 1 << 18
#: Most bytes of such a word; longer ones are folded where they stand.
COMMON_BYTES = 64
#: Words of a piece of texts; a longer text is a piece of its own.
PIECE_WORDS = 1 << 21
PAIR_BUCKETS = 1 << 14
#: Noncharacters that part the entries of a bucket.
MARK, MIDDLE, CUT = "\uffff", "\ufffe", "\ufdd0"
#: Ranks are code points below the surrogates.
MOST_RANKS = 0xD7FF
#: Stands for rank 0, as translate() takes the zero character for a deletion.
ZERO = "\ud7ff"
#: Above all ranks: a pair that is no token.
NONE = 1 << 30


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base64 and its rank on every line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if max(ranks.values()) >= MOST_RANKS:
        raise ValueError(f"ranks must be below {MOST_RANKS}")
    if any(rank == 0 and len(token) > 1 for token, rank in ranks.items()):
        raise ValueError("rank 0 must be a single byte")
    return ranks


def token_char(rank: int) -> str:
    return chr(rank) if rank else ZERO


def java_pattern(pattern: str) -> str:
    """The splitting pattern with white space as Unicode has it."""
    return pattern.replace(r"\S", r"\P{IsWhite_Space}").replace(r"\s", r"\p{IsWhite_Space}")


def literal_array(buckets: list[str]) -> Column:
    """An array of strings as one constant, folded when the plan is made."""
    return F.split(F.lit(CUT.join(buckets)), CUT, -1)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bucket_of(key: Column, buckets: int) -> Column:
    return (F.crc32(key.cast("binary")) % buckets + 1).cast("int")


def _pairs(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Every pair of tokens whose bytes together are a token, and that token."""
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                yield left, right, rank


@lru_cache(maxsize=2)
def _pair_text(path: str) -> tuple[str, ...]:
    """Entries of every pair of tokens whose bytes together are a token, by bucket."""
    buckets = [""] * PAIR_BUCKETS
    for left, right, rank in _pairs(load_ranks(path)):
        pair = token_char(left) + token_char(right)
        buckets[zlib.crc32(pair.encode()) % PAIR_BUCKETS] += MARK + pair + token_char(rank)
    return tuple(3 * MARK + b for b in buckets)


@dataclass
class Ranks:
    """The rank map as arrays: the rank of each byte, pairs of ranks in order with what they merge into, bytes by rank."""

    bytes: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    pieces: pa.Array

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Ranks:
        # the last entry is above all pairs
        rows = sorted((left << 32 | right, rank) for left, right, rank in _pairs(ranks)) + [(1 << 62, NONE)]
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        pairs, merged = (np.array(column, np.int64) for column in zip(*rows))
        return cls(np.array([ranks[bytes([b])] for b in range(256)]), pairs, merged, pa.array(pieces, pa.binary()))

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of tokens merge into; ``NONE`` where they do not."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merged[at], NONE)

    def fold(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, one after the other, and how many each has; ``data`` are the words' bytes.

        Each step merges the pair of smallest rank of every word, wherever it stands in the word; words
        without a pair are put aside. ``ranks`` holds what a token and the next one merge into.
        """
        tokens, word = self.bytes[data], np.repeat(np.arange(len(sizes)), sizes)

        def ranked(at: np.ndarray) -> np.ndarray:
            found = np.full(len(at), NONE, np.int64)
            inside = np.flatnonzero(at + 1 < len(word))
            inside = inside[word[at[inside]] == word[at[inside] + 1]]
            found[inside] = self.merge(tokens[at[inside]], tokens[at[inside] + 1])
            return found

        ranks = ranked(np.arange(len(word)))
        done = []
        while len(word):
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            each = np.diff(begins, append=len(word))
            best = np.repeat(np.minimum.reduceat(ranks, begins), each)
            ended = best == NONE
            if ended.any():
                done.append((word[ended], tokens[ended]))
                word, tokens, ranks, best = (v[~ended] for v in (word, tokens, ranks, best))
            at = np.flatnonzero(ranks == best)
            # of pairs that share a token, from the left every other one
            n = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, n, 0))
            at = at[(n - run) % 2 == 0]
            tokens[at] = ranks[at]
            keep = np.ones(len(word), bool)
            keep[at + 1] = False
            word, tokens, ranks = word[keep], tokens[keep], ranks[keep]
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            ranks[changed] = ranked(changed)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        word, tokens = (np.concatenate(v) for v in zip(*done))
        return tokens[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(sizes))


@dataclass
class Coder:
    """The tokens of words: those of common words are known, other words are folded."""

    ranks: Ranks
    words: pa.Array
    tokens: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, ranks: Ranks, entries: list[str]) -> Coder:
        words, coded = zip(*(entry.split(MIDDLE) for entry in entries)) if entries else ((), ())
        sizes = np.array([len(tokens) for tokens in coded], np.int64)
        tokens = np.frombuffer("".join(coded).encode("utf-32-le"), "<u4").astype(np.int64)
        tokens[tokens == ord(ZERO)] = 0
        return cls(ranks, pa.array(words, pa.string()), tokens, sizes)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, one after the other, and how many each has."""
        coded = words.dictionary_encode()
        distinct, refs = coded.dictionary, coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(distinct, value_set=self.words), -1).to_numpy()
        others = pc.filter(distinct, pa.array(at < 0)).cast(pa.binary())
        bytes_of = b"".join(others.to_pylist())
        folded, n = self.ranks.fold(np.frombuffer(bytes_of, np.uint8), pc.binary_length(others).to_numpy().astype(np.int64))
        sizes = np.concatenate([self.sizes, n])
        starts = np.cumsum(sizes) - sizes
        place = at.astype(np.int64)
        place[at < 0] = len(self.sizes) + np.arange(len(n))
        place = place[refs]
        begin = starts[place]
        return np.concatenate([self.tokens, folded])[ranges(begin, begin + sizes[place])], sizes[place]

    def texts(self, doc_ids: pa.Array, words: pa.ListArray) -> pa.RecordBatch:
        """Rows of ``doc_id, ids, decoded``."""
        ids, n = self.encode(words.flatten())
        edges = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]
        made = self.ranks.pieces.take(pa.array(ids))
        _, offsets, data = made.buffers()
        ends = np.frombuffer(offsets, np.int32, len(ids) + 1)[edges]

        def binary(at: np.ndarray, values: pa.Buffer | None) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(doc_ids), [None, pa.py_buffer(at.astype(np.int32).tobytes()), values or pa.py_buffer(b"")])

        columns = [doc_ids, binary(4 * edges, pa.py_buffer(ids.astype("<u4").tobytes())), binary(ends, data)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most ``most`` words, or of one row."""
    sums = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("words")).to_numpy())])
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(sums, sums[begin] + most, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


class ByteBpe:
    """Expressions of one vocabulary."""

    def __init__(self, rank_path: str, pattern: str):
        self.ranks = load_ranks(rank_path)
        self.pattern = java_pattern(pattern)
        self.pairs = literal_array(list(_pair_text(rank_path)))
        self.latin = "".join(map(chr, range(256)))
        self.bytes = "".join(token_char(self.ranks[bytes([b])]) for b in range(256))

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def encode_word(self, word: Column) -> Column:
        """The tokens of one word, as a string of token characters."""
        return bound(self.pairs, lambda table: self._encode_word(table, word))  # one copy of the literal in the plan

    def _merged(self, table: Column, pair: Column) -> Column:
        """The token that a pair of tokens merges into; ``MARK``, which is above all tokens, if none."""
        bucket = F.element_at(table, bucket_of(pair, PAIR_BUCKETS))
        # the third character of a bucket is the mark: the one found for position 0
        return F.substring(bucket, F.position(F.concat(F.lit(MARK), pair), bucket) + 3, F.lit(1))

    def _all_merged(self, table: Column, tokens: Column) -> Column:
        """What each pair of neighbours merges into, one character a pair."""
        each = F.split(tokens, "")
        n = F.size(each) - 1
        pairs = F.zip_with(F.slice(each, 1, n), F.slice(each, 2, n), lambda a, b: F.concat(a, b))
        return F.array_join(F.transform(pairs, lambda p: self._merged(table, p)), "")

    def _encode_word(self, table: Column, word: Column) -> Column:
        """The fold. It carries the tokens and what their pairs merge into. A merge in one place
        changes two pairs, and only these are looked up; after a merge in several places
        all pairs are.
        """
        start = F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), self.latin, self.bytes)
        last = F.lit(1 << 30)

        def state(tokens: Column, pairs: Column) -> Column:
            return F.struct(tokens.alias("tokens"), pairs.alias("pairs"))

        def recounted(tokens: Column) -> Column:
            return bound(tokens, lambda t: state(t, F.when(F.char_length(t) < 2, MARK).otherwise(self._all_merged(table, t))))

        def merge(tokens: Column, pairs: Column, best: Column, at: Column) -> Column:
            here = at["at"]
            once = state(
                F.concat(F.substring(tokens, F.lit(1), here - 1), best, F.substring(tokens, here + 2, last)),
                F.concat(
                    F.when(
                        here > 1,
                        F.concat(
                            F.substring(pairs, F.lit(1), here - 2),
                            self._merged(table, F.concat(F.substring(tokens, here - 1, F.lit(1)), best)),
                        ),
                    ).otherwise(""),
                    F.when(
                        here + 1 < F.char_length(tokens),
                        F.concat(
                            self._merged(table, F.concat(best, F.substring(tokens, here + 2, F.lit(1)))),
                            F.substring(pairs, here + 2, last),
                        ),
                    ).otherwise(""),
                ),
            )
            often = recounted(F.replace(tokens, F.substring(tokens, here, F.lit(2)), best))
            return F.when(F.position(best, pairs, here + 1) == 0, once).otherwise(often)

        def step(sofar: Column, _: Column) -> Column:
            tokens, pairs = sofar["tokens"], sofar["pairs"]

            def move(best: Column) -> Column:
                # nothing merges any more: an end state without pairs
                return F.when((best == MARK) | (best == ""), state(tokens, F.lit(""))).otherwise(
                    bound(F.struct(F.position(best, pairs).alias("at")), lambda at: merge(tokens, pairs, best, at))
                )

            return F.when(pairs == "", sofar).otherwise(bound(F.array_min(F.split(pairs, "")), move))

        def fold(begin: Column) -> Column:
            rounds = F.sequence(F.lit(1), F.char_length(begin) - 1)
            return F.when(F.char_length(begin) < 2, begin).otherwise(
                F.aggregate(rounds, recounted(begin), step, lambda s: s["tokens"])
            )

        return bound(start, fold)

    def common_words(self, docs: DataFrame, most: int) -> list[str]:
        """The ``most`` frequent distinct words of the whole corpus, each with its tokens."""
        counted = (
            docs.select(F.explode(self.words(F.coalesce("text", F.lit("")))).alias("word"))
            .groupBy("word")
            .agg(F.count("*").alias("times"))
            .where("times > 1")
            .where(F.octet_length("word") <= COMMON_BYTES)
        )
        chosen = counted.orderBy(F.desc("times"), "word").limit(most).select("word")
        plain = ~(F.contains("word", F.lit(MARK)) | F.contains("word", F.lit(MIDDLE)) | F.contains("word", F.lit(CUT)))
        spread = written(chosen.where(plain), "bpe-words").repartition(docs.sparkSession.sparkContext.defaultParallelism, "word")
        coded = spread.select("word", self.encode_word(F.col("word")).alias("tokens"))
        # bounded: at most ``most`` rows of words of at most COMMON_BYTES bytes
        return [f"{word}{MIDDLE}{tokens}" for word, tokens in coded.toLocalIterator(prefetchPartitions=True)]

    def encoded(self, docs: DataFrame, most: int = COMMON_WORDS, piece: int = PIECE_WORDS) -> DataFrame:
        """``doc_id``, the text's ids as little-endian unsigned 32-bit numbers, and its decoded bytes."""
        # bounded: the rank map and the common words
        sent = docs.sparkSession.sparkContext.broadcast(Coder.of(Ranks.of(self.ranks), self.common_words(docs, most)))

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, piece):
                    yield sent.value.texts(part.column("doc_id"), part.column("words"))

        binary = [T.StructField(name, T.BinaryType()) for name in ("ids", "decoded")]
        words = docs.select("doc_id", self.words(F.coalesce("text", F.lit(""))).alias("words"))
        return words.mapInArrow(encode, T.StructType([docs.schema["doc_id"], *binary]))


def encode_and_decode(docs: DataFrame, rank_path: str, pattern: str, most: int = COMMON_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    A null or empty text has no tokens and the digests of the empty string. Repeated
    rows give equal rows; other columns are ignored.
    """
    coded = ByteBpe(rank_path, pattern).encoded(docs, most)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
