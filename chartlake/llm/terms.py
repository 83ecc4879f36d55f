"""Words as maximal runs of chosen bytes, split for a whole batch of texts at once.

All bytes of 0x80 and above belong to words, so words stay valid UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def byte_table(digits: bool) -> np.ndarray:
    """What each byte becomes in a word, 0 for a byte that is in none.

    A-Z become lower case; a-z and non-ASCII bytes stay, 0-9 if ``digits``.
    """
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("a"):ord("z") + 1] = table[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    if digits:
        table[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return table


def split(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of ``texts`` (large strings, no null), the place among them of each
    word in turn, and the offsets of the texts in the words."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, int)
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    lowered = table[raw]
    inside = lowered != 0
    # a word starts where the byte before is in none, and at the start of each text
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(raw)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    places = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [
        None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(lowered[inside])])
    coded = pc.dictionary_encode(words)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, ends)
