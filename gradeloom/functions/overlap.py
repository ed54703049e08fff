"""Token overlap of a (prediction, reference) pair, one Arrow batch at a time.

A pair is one row, so its n-gram and subsequence counts need no shuffle. The
whole batch is counted together with array operations on integer token codes;
every BLEU and ROUGE column is later derived from the returned struct by native
expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions.porter import rouge_stem
from gradeloom.functions.text import Splitter

# Text bytes of the rows that are counted from end to end before the next ones, text bytes split
# together, and tokens counted together: what is held stays small whatever the batch holds.
RANGE_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
SLICE_TOKENS = 1 << 16


@dataclass(frozen=True)
class Count:
    """What to count on one pair of prepared texts."""

    splitter: Splitter
    max_n: int
    lcs: bool = False
    stem: bool = False

    @property
    def fields(self) -> list[str]:
        grams = [f"m{n}" for n in range(1, self.max_n + 1)]
        return ["pred_len", "ref_len", *grams] + (["lcs"] if self.lcs else [])


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence by bit-parallel rows over Python integers."""
    # a common beginning belongs to some longest subsequence
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    same = int(apart[0]) if len(apart) else n
    short, long = sorted((a[same:].tolist(), b[same:].tolist()), key=len)
    if not short:
        return same
    positions: dict[int, int] = {}
    for i, token in enumerate(long):
        positions[token] = positions.get(token, 0) | (1 << i)
    full = (1 << len(long)) - 1
    row = full
    for token in short:
        hit = row & positions.get(token, 0)
        if hit:
            row = (row + hit) | (row - hit)
    return same + len(long) - (row & full).bit_count()


def split_tokens(texts: pa.Array, splitter: Splitter) -> tuple[pa.Array, np.ndarray]:
    """All tokens of the texts in one array, and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if splitter.wide and pc.any(pc.match_substring_regex(texts, splitter.wide)).as_py():
        return _split_by_pattern(texts, splitter.pattern)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    chars = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, dtype=np.uint8)
    ends = ends - ends[0]
    is_token = np.zeros(256, dtype=bool)
    is_token[list(splitter.token_bytes)] = True
    inside = is_token[chars]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # a token also begins where its text does
    heads = ends[:-1][ends[:-1] < len(chars)]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    starts = np.concatenate([[0], np.cumsum(inside)])[at]
    bounds = np.concatenate([starts, [int(inside.sum())]]).astype(np.int64)
    tokens = pa.Array.from_buffers(
        pa.large_string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(chars[inside])]
    )
    return tokens, np.diff(np.searchsorted(at, ends))


def _split_by_pattern(texts: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray]:
    pieces = pc.split_pattern_regex(texts, pattern)
    lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
    flat = pieces.flatten()
    # a separator at either end of a text leaves an empty piece there
    real = pc.not_equal(flat, "")
    owner = np.repeat(np.arange(len(texts)), lengths)[real.to_numpy(zero_copy_only=False)]
    return flat.filter(real), np.bincount(owner, minlength=len(texts))


def encoded_tokens(texts: pa.Array, splitter: Splitter) -> tuple[list[pa.DictionaryArray], np.ndarray]:
    """``split_tokens`` for a whole batch, split a slice of its rows at a time and kept as codes."""
    encoded, lengths = [], []
    for a, b in row_slices(text_bytes(texts), SLICE_BYTES):
        tokens, n = split_tokens(texts.slice(a, b - a), splitter)
        encoded.append(tokens.dictionary_encode())
        lengths.append(n)
    return encoded, np.concatenate(lengths)


def one_dictionary(encoded: list[pa.DictionaryArray]) -> tuple[np.ndarray, pa.Array]:
    """Codes of all tokens in one array, and the distinct tokens."""
    whole = pa.chunked_array(encoded).unify_dictionaries()
    codes = [chunk.indices.to_numpy(zero_copy_only=False) for chunk in whole.chunks]
    return np.concatenate(codes), whole.chunk(0).dictionary


def token_codes(encoded: list[pa.DictionaryArray], stem: bool) -> tuple[np.ndarray, int]:
    """Integer code per token, equal for equal (stemmed) tokens, and the number of codes."""
    codes, words = one_dictionary(encoded)
    size = len(words)
    if stem and size:
        stems, distinct = pd.factorize(np.array([rouge_stem(w) for w in words.to_pylist()], dtype=object))
        return stems.astype(np.int32)[codes], len(distinct)
    return codes, size


def row_slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` in all, or of a single larger row."""
    out, start, filled = [], 0, 0
    for row, size in enumerate(sizes.tolist()):
        if filled and filled + size > most:
            out.append((start, row))
            start, filled = row, 0
        filled += size
    out.append((start, len(sizes)))
    return out


def text_bytes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def overlap_counts(pred: pa.Array, ref: pa.Array, count: Count) -> pa.StructArray:
    ranges = row_slices(text_bytes(pred) + text_bytes(ref), RANGE_BYTES)
    parts = [_range_counts(pred.slice(a, b - a), ref.slice(a, b - a), count) for a, b in ranges]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([p[name] for p in parts]), pa.int64()) for name in count.fields], count.fields
    )


def _range_counts(pred: pa.Array, ref: pa.Array, count: Count) -> dict[str, np.ndarray]:
    pred_tokens, pred_len = encoded_tokens(pred, count.splitter)
    # a reference has a prediction of every model, and is split once
    refs = pc.fill_null(ref, "").dictionary_encode()
    which = refs.indices.to_numpy(zero_copy_only=False)
    ref_tokens, own_len = encoded_tokens(refs.dictionary, count.splitter)
    codes, size = token_codes([*pred_tokens, *ref_tokens], count.stem)
    pred_at = np.concatenate([[0], np.cumsum(pred_len)])
    ref_at = (np.cumsum(own_len) - own_len + pred_at[-1])[which]
    ref_len = own_len[which]
    parts = []
    for a, b in row_slices(pred_len + ref_len, SLICE_TOKENS):
        n = ref_len[a:b]
        at = np.repeat(ref_at[a:b] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        part = np.concatenate([codes[pred_at[a]:pred_at[b]], codes[at]]).astype(np.int64)
        parts.append(_slice_counts(part, pred_len[a:b], ref_len[a:b], size, count.max_n, count.lcs))
    return {"pred_len": pred_len, "ref_len": ref_len} | {
        name: np.concatenate([p[name] for p in parts]) for name in parts[0]
    }


def _slice_counts(
    codes: np.ndarray, pred_len: np.ndarray, ref_len: np.ndarray, size: int, max_n: int, lcs: bool
) -> dict[str, np.ndarray]:
    rows = len(pred_len)
    n_pred = int(pred_len.sum())
    lens = np.concatenate([pred_len, ref_len])
    ends = np.cumsum(lens)
    # tokens from here to the end of the same text, and the pair each token belongs to
    left = np.repeat(ends, lens) - np.arange(len(codes))
    pair = np.repeat(np.concatenate([np.arange(rows)] * 2), lens)

    columns = {}
    at = np.arange(len(codes))
    gram = pair
    for n in range(1, max(max_n, int(lcs)) + 1):
        keep = left[at] >= n
        at, gram = at[keep], gram[keep]
        # a gram is its (n-1)-gram, already tied to the pair, plus one more token
        gram, distinct = pd.factorize(gram * max(size, 1) + codes[at + n - 1])
        middle = int(np.searchsorted(at, n_pred))  # predictions come first
        shared = np.minimum(
            np.bincount(gram[:middle], minlength=len(distinct)),
            np.bincount(gram[middle:], minlength=len(distinct)),
        )
        if n <= max_n:
            owner = np.zeros(len(distinct), dtype=np.int64)
            owner[gram] = pair[at]
            columns[f"m{n}"] = np.bincount(owner, weights=shared, minlength=rows).astype(np.int64)
        # a longer gram can only be shared where this one is
        alive = shared[gram] > 0
        at, gram = at[alive], gram[alive]
        if n == 1 and lcs:
            columns["lcs"] = _lcs_lengths(codes[at], pair[at], at < n_pred, rows)
    # in the declared order
    return {name: columns[name] for name in sorted(columns, key=lambda c: (c == "lcs", c))}


def _lcs_lengths(codes: np.ndarray, pair: np.ndarray, in_pred: np.ndarray, rows: int) -> np.ndarray:
    """LCS per pair over the tokens that both of its texts have; the others cannot take part."""
    sides = []
    for side in (in_pred, ~in_pred):
        ends = np.cumsum(np.bincount(pair[side], minlength=rows))
        sides.append((codes[side], [0, *ends.tolist()]))
    (p, p_at), (r, r_at) = sides
    return np.array(
        [lcs_length(p[p_at[i]:p_at[i + 1]], r[r_at[i]:r_at[i + 1]]) for i in range(rows)], dtype=np.int64
    )


def overlap(parts: Mapping[str, tuple[Column, Column, Count]]) -> Column:
    """One struct per name, counted on that name's pair of prepared texts.

    All parts come from a single Arrow call, so a batch crosses to Python once.
    """
    counts = [part[2] for part in parts.values()]
    names = list(parts)

    def count_all(*texts: pa.Array) -> pa.Array:
        found = [overlap_counts(texts[2 * i], texts[2 * i + 1], c) for i, c in enumerate(counts)]
        return pa.StructArray.from_arrays(found, names)

    inner = [f"{name}: STRUCT<{', '.join(f'{f}: BIGINT' for f in c.fields)}>" for name, c in zip(names, counts)]
    return F.arrow_udf(count_all, f"STRUCT<{', '.join(inner)}>")(
        *[text for pred, ref, _ in parts.values() for text in (pred, ref)]
    )
