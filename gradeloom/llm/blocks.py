"""Blocks of documents: consecutive rows of a task, few enough to be worked on as a whole.

What a block holds more than once (a word, a pair of ids) crosses the network once a block,
not once a document, so a very common one is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

BLOCK_ROWS = 8192
BLOCK_BYTES = 16 << 20


def parts(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """The rows in pieces of one batch, and whether a piece is the last of its block.

    A block has at most ``rows`` rows and, but for one longer text, ``size`` bytes of column ``text``.
    """
    held: pa.RecordBatch | None = None
    n = used = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        sums = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        begin = 0
        while begin < batch.num_rows:
            fit = int(np.searchsorted(sums, sums[begin] + size - used, "right")) - 1
            end = min(begin + rows - n, fit, batch.num_rows)
            if end <= begin and n:
                yield held, True
                held, n, used = None, 0, 0
                continue
            end = max(end, begin + 1)
            if held is not None:
                yield held, False
            held = batch.slice(begin, end - begin)
            n, used, begin = n + end - begin, used + int(sums[end] - sums[begin]), end
    if held is not None:
        yield held, True


def block_ids() -> Iterator[int]:
    """Numbers that no other task of the job gives, the same when a task is run again."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    k = 0
    while True:
        yield first + k
        k += 1


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    sizes = ends - starts
    total = int(sizes.sum())
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
