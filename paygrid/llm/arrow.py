"""Arrow batch helpers for operators whose per-document work runs in numpy inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

# Bytes of text that one numpy step works on; a longer text is a step of its own.
SLICE_BYTES = 2 << 20


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # glibc only


def release_memory() -> None:
    """Return freed memory to the system: Spark keeps a worker process, with all its allocator holds, for later stages."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` bytes of text (one row at least).

    What the slices took is given back at the end of the batch.
    """
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield batch.slice(start)
    release_memory()


def map_slices(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               column: str = "text") -> DataFrame:
    """``df.mapInArrow`` that calls ``step`` on bounded slices of each batch."""

    def run(batches):
        for b in batches:
            for s in text_slices(b, column):
                yield step(s)

    return df.mapInArrow(run, schema)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` for each start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


# Kinds of bytes for ``split_tokens``: part of a token, between tokens, and between tokens that are not neighbours.
INSIDE, BLANK, BREAK = 0, 1, 2


def split_tokens(column: pa.Array, kinds: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every token, whether the next token is its neighbour, and the distinct tokens.

    ``kinds`` says which of the 256 bytes are inside a token, ``fold`` what each byte becomes. Tokens of
    different texts are not neighbours. Null texts have no token. Both tables must treat all bytes from 0x80 alike.
    """
    text = pc.fill_null(column.cast(pa.string()), "")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = kinds[data]
    inside = kind == INSIDE
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), pa.array([], pa.string())
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = inside[begins]              # a text that ends in a token does not run into the next
    starts = np.flatnonzero(first)
    ends = np.concatenate([[0], np.cumsum(np.bincount(np.cumsum(first)[inside] - 1))]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(fold[data[inside]])).dictionary_encode()
    row = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(kind == BREAK)[starts]
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    return row, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), joined, found.dictionary


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of every string."""
    return np.array([xxhash.xxh3_64_intdigest(v.as_buffer()) for v in values.cast(pa.binary())], dtype=np.uint64)
