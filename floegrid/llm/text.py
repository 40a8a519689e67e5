"""Vectorised text helpers for functions that run on Arrow batches inside tasks.

A batch is cut into chunks of a few megabytes, so memory does not depend on the batch size or on
the length of the average document; one very long document makes a chunk of its own. Text is
handled as one byte buffer with offsets, taken from Arrow without a Python string per row.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
SPACE = b"\t\n\x0b\x0c\r "
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)
# An odd value for every byte; products with powers of an odd base make the word hash.
BYTE_VALUE = np.random.default_rng(20_01).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """A value built once in each Python worker, however many tasks the worker runs."""
    store = sys.modules.setdefault("_floegrid_worker_values", types.ModuleType("_floegrid_worker_values"))
    values = store.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


def word_table(separators: bytes | None = None) -> np.ndarray:
    """True for bytes of a word: all but `separators`, or ASCII letters and digits and all other than ASCII."""
    table = np.ones(256, bool)
    if separators is not None:
        table[list(separators)] = False
        return table
    table[:128] = False
    table[ord("0"):ord("9") + 1] = True
    table[ord("a"):ord("z") + 1] = True
    return table


def lower_table() -> np.ndarray:
    """Bytes with A-Z in lower case and all others as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and the n + 1 offsets; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]), offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text and `rows` rows each, or a single row."""
    for batch in batches:
        text = batch.column(column)
        sizes = np.asarray(pa.compute.binary_length(text).fill_null(0)).astype(np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and (total + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_B
    x = (x ^ (x >> np.uint64(27))) * MIX_C
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered combination of two hashes."""
    return mix(a * MIX_A + b)


def _powers(n: int) -> np.ndarray:
    base = np.full(n, MIX_A, np.uint64)
    base[:1] = 1
    return np.multiply.accumulate(base)


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of word bytes; a run never crosses two texts. `inside`: flag of each byte."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (first[:-1] | ~before))
    ends = np.flatnonzero(inside & (first[1:] | ~after)) + 1
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word; equal words have equal hashes in every task."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    at = place + np.repeat(starts, lengths)
    terms = BYTE_VALUE[data[at]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, firsts) ^ (lengths.astype(np.uint64) * MIX_C))


def texts_words(column: pa.Array, table: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, the text of each word, and the n + 1 word offsets of the texts."""
    data, offsets = packed(column)
    if lower:
        data = lower_table()[data]
    starts, ends = word_spans(data, offsets, table[data])
    owner = np.searchsorted(offsets, starts, "right") - 1
    return word_hashes(data, starts, ends), owner, np.searchsorted(owner, np.arange(len(column) + 1))


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as a column of signed longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
