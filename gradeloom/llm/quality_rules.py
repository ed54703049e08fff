"""Quality rules: counts of words, lines and symbols, and compression bands.

A text's zstandard ratio (compressed over raw bytes) tells repetition (low) from
noise (high). Ratios are taken over the whole document and over fixed chunks of it;
each must lie inside the band that belongs to its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import slices

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
CHUNK_BYTES = 2048
ZSTD_LEVEL = 3

STATS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, chunk_low double, chunk_high double"
)
FIGURES = [c.split()[0] for c in STATS.split(", ")][1:]


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for lengths up to ``max_bytes`` (None: any length)."""

    max_bytes: int | None
    low: float
    high: float


#: Short texts compress less, as each pays for the frame and its own first words. Upper limits are
#: set wide, for noise only, as no label tells it. Lower limits are those of :func:`learn_bands` on
#: the documents of scale 0.1, rounded to three places; where it has too few of a length, they are wide too.
DOCUMENT_BANDS = (
    Band(256, 0.45, 1.10),
    Band(512, 0.524, 0.88),
    Band(1024, 0.487, 0.80),
    Band(2048, 0.446, 0.72),
    Band(4096, 0.433, 0.72),
    Band(8192, 0.407, 0.66),
    Band(16384, 0.396, 0.66),
    Band(65536, 0.35, 0.62),
    Band(None, 0.30, 0.62),
)
#: For every chunk of a text that has one.
CHUNK_BAND = Band(None, 0.451, 0.70)


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside any window of three that occurs twice or more, first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    pairs = ids[:-1] * n + ids[1:]
    if n > 1_600_000:  # three positions no longer fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def text_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    words = raw.split()  # on bytes: exactly the six ASCII spaces
    inside = b"".join(words)
    letters = len(inside) - len(inside.translate(None, _LEADING)) if inside else 0
    lines, seen = 0, set()
    for line in raw.split(b"\n"):
        if line.strip():
            if line in seen:
                lines += 1
            else:
                seen.add(line)
    return len(words), letters, len(raw) - len(raw.translate(None, SYMBOLS)), lines, repeated_words(words)


#: Every byte that begins a code point.
_LEADING = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def text_ratios(raw: bytes, squeeze, chunk: int = CHUNK_BYTES) -> tuple[float, float, float]:
    """Ratio of the whole text, and the lowest and highest of its chunks (the whole's, if it is shorter than one).

    The last chunk ends with the text, and overlaps the one before where the length is no multiple.
    """
    if not raw:
        return 1.0, 1.0, 1.0
    whole = len(squeeze(raw)) / len(raw)
    begins = list(range(0, len(raw) - chunk + 1, chunk))
    if begins and len(raw) % chunk:
        begins.append(len(raw) - chunk)
    full = [len(squeeze(raw[i : i + chunk])) / chunk for i in begins]
    return whole, min(full, default=whole), max(full, default=whole)


def text_statistics(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the figures the rules look at."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
        for part in slices(batches):
            rows = []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                raw = text or b""
                rows.append((*text_counts(raw), len(raw), *text_ratios(raw, squeeze)))
            columns = [pa.array(c, pa.int64() if i < 6 else pa.float64()) for i, c in enumerate(zip(*rows))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), *columns], names=[c.split()[0] for c in STATS.split(", ")]
            )

    return docs.select("doc_id", "text").mapInArrow(measure, STATS)


def in_band(ratio: Column, size: Column, bands: Sequence[Band]) -> Column:
    """Whether a ratio lies inside the band of its length."""
    inside = None
    for band in reversed(bands):
        here = ratio.between(band.low, band.high)
        inside = here if inside is None else F.when(size <= band.max_bytes, here).otherwise(inside)
    return inside


def verdict(
    figure: Callable[[str], Column] = F.col,
    bands: Sequence[Band] = DOCUMENT_BANDS,
    chunk_band: Band = CHUNK_BAND,
) -> tuple[Column, Column]:
    """``base_failed`` and ``kept``, over the columns that ``figure`` gives for the names of the statistics."""
    base_failed = (figure("n_words") < 50) | (100 * figure("n_repeat_words") > 50 * figure("n_words"))
    banded = (
        in_band(figure("ratio"), figure("n_bytes"), bands)
        & (
            (figure("n_bytes") < CHUNK_BYTES)
            | (figure("chunk_low") >= chunk_band.low) & (figure("chunk_high") <= chunk_band.high)
        )
    )
    return base_failed, ~base_failed & banded


def learn_bands(
    docs: DataFrame,
    labels: DataFrame,
    bands: Sequence[Band] = DOCUMENT_BANDS,
    chunk_band: Band = CHUNK_BAND,
    share: float = 0.001,
    room: float = 0.02,
    fewest: int = 100,
) -> tuple[tuple[Band, ...], Band]:
    """``bands`` and ``chunk_band`` with lower limits from the documents labelled good.

    A limit leaves out ``share`` of the good documents of its length that pass the base rules, less
    ``room`` for texts unlike them; lengths with fewer than ``fewest`` of these keep their limit.
    Labels are learned from training rows only: crc32(doc_id as text) mod 5 is not 0. All of these
    count, in sketches; the driver gets one row per band. Rows without an id or label are ignored.
    """
    training = labels.where((F.col("quality") == 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    good = docs.select("doc_id", "text").join(training.select("doc_id").distinct(), "doc_id", "left_semi")
    last = F.lit(len(bands) - 1)
    for k, band in reversed(list(enumerate(bands[:-1]))):
        last = F.when(F.col("n_bytes") <= band.max_bytes, k).otherwise(last)
    chunked = F.when(F.col("n_bytes") >= CHUNK_BYTES, F.struct(F.lit(-1).alias("band"), F.col("chunk_low").alias("ratio")))
    ratios = text_statistics(good).where(~verdict()[0]).select(F.explode(F.array(F.struct(last.alias("band"), "ratio"), chunked)).alias("r"))
    lowest = F.percentile_approx("r.ratio", share, 10_000).alias("low")
    rows = ratios.where("r is not null").groupBy("r.band").agg(F.count("*").alias("n"), lowest).collect()
    found = {r["band"]: r["low"] - room for r in rows if r["n"] >= fewest}
    limits = tuple(Band(b.max_bytes, found.get(k, b.low), b.high) for k, b in enumerate(bands))
    return limits, Band(None, found.get(-1, chunk_band.low), chunk_band.high)


def judge(docs: DataFrame, bands: Sequence[Band] = DOCUMENT_BANDS, chunk_band: Band = CHUNK_BAND) -> DataFrame:
    """The statistics of every document with ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rules. Repeated rows are
    judged alike, ties at a limit count as inside, other columns are ignored.
    """
    base_failed, kept = verdict(bands=bands, chunk_band=chunk_band)
    return text_statistics(docs).withColumn("base_failed", base_failed).withColumn("kept", kept)


def keep_good(docs: DataFrame, bands: Sequence[Band] = DOCUMENT_BANDS, chunk_band: Band = CHUNK_BAND) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`judge` keeps."""

    def measure(texts: pd.Series) -> pd.DataFrame:
        squeeze = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
        rows = []
        for text in texts:
            raw = (text or "").encode()
            rows.append((*text_counts(raw), len(raw), *text_ratios(raw, squeeze)))
        return pd.DataFrame(rows, columns=FIGURES)

    name = "_figures"
    while name in docs.columns:
        name += "_"
    figures = F.pandas_udf(measure, STATS.partition(", ")[2])
    kept = verdict(lambda c: F.col(f"{name}.{c}"), bands, chunk_band)[1]
    return docs.withColumn(name, figures("text")).where(kept).drop(name)
