"""Vectorised text splitting inside tasks, for Arrow batches of whole texts."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes handled at once in a task; a longer text is handled alone.
CHUNK_BYTES = 4 << 20


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each; null texts become empty."""
    filled = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
    columns = [filled if i == text else c for i, c in enumerate(batch.columns)]
    batch = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    ends = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False))
    try:
        yield from _cut(batch, ends, limit)
    finally:
        give_back()


def give_back() -> None:
    """Return what a batch has used to the system: workers live on, idle, beside the next job's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc can
        ctypes.CDLL(None).malloc_trim(0)


def _cut(batch: pa.RecordBatch, ends: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z lowered.

    Returns the distinct words, each occurrence's place among them, and the
    offsets of the texts in the occurrences.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    filled = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    offsets = kept[np.concatenate([[0], ends]).astype(np.int64)]
    coded = pc.dictionary_encode(flat.filter(filled))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), offsets


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.large_binary()).to_pylist()),
                       dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def chain(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of aligned columns, depending on their order and number."""
    out = np.full(len(columns[0]), np.uint64(len(columns)))
    for c in columns:
        out = mix(out * np.uint64(3) + c)
    return out
