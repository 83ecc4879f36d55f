"""Packing tokenised documents into windows by minimum bin slack.

A document's ids are its text's ids and one end id. Ids are cut into full
windows and one remaining piece, so the pieces are described completely by the
histogram of their lengths, which has at most ``window`` rows whatever the
data size. The histogram goes to the driver; there :func:`plan` repeats: take
the longest remaining length, then find by a bitset subset-sum over the
remaining multiset which lengths fill the rest of the window closest to its
capacity, read the counts back from the bitset's history, and use that filling
as often as the counts allow. Spark numbers the pieces of each length and
joins them to the plan's rows for that length.

Text is encoded with the rank file of the byte-level vocabulary and the added
tokens of its ``tokenizers`` file: the ids that file gives without its special
template (the tests compare the two), about nine times as fast. So the string
of an added token in a text, like ``<|endoftext|>``, is that token's one id.

Defined results: null text counts as empty, so it gives the end id alone;
equal rows give equal pieces that land in different places; documents longer
than the window are cut; an empty table gives no pieces; other columns are
ignored.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, saved
from .words import give_back

WINDOW = 2048
END_ID = 1

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType())])

_ENCODERS: dict[str, object] = {}


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file, by their strings."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"added token {t['content']!r} takes more than its own string")
    return {t["content"]: t["id"] for t in tokens}


def encoder(path: str | None = None):
    """The encoder of a rank file (default: the public 50k byte-level vocabulary).

    Added tokens come from the ``tokenizers`` file of the same name beside it;
    a rank file that stands alone has none.
    """
    key = path or ""
    if key not in _ENCODERS:
        import base64

        import public_tokenizers as P
        import tiktoken
        path = path or P.path("byte_bpe_50k.tiktoken")
        beside = os.path.splitext(path)[0] + ".json"
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[key] = tiktoken.Encoding("byte_bpe", pat_str=P.PATTERN, mergeable_ranks=ranks,
                                           special_tokens=added_tokens(beside) if os.path.exists(beside) else {})
    return _ENCODERS[key]


def pieces(docs: DataFrame, window: int = WINDOW, vocab: str | None = None) -> DataFrame:
    """Every document's ids cut at multiples of ``window``; one row a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = functools.partial(encoder(vocab).encode, allowed_special="all")
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py()
                ids = np.array([*(encode(text) if text else ()), END_ID], dtype="<u4")
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    for column, value in zip(out, (doc_id, start, len(part),
                                                   zlib.crc32(part.tobytes()), len(ids))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=PIECES.fieldNames())
            give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The sub-multiset of ``counts`` whose sum is closest to ``capacity`` from below."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, c in counts.items() if c and x <= capacity), reverse=True):
        left, take = min(counts[length], capacity // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= take * length
    return used


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Fillings and how often each is used, in order; covers the histogram exactly."""
    left = {k: v for k, v in histogram.items() if v}
    out = []
    while left:
        seed = max(left)
        rest = {k: v for k, v in left.items() if k <= window - seed}
        if seed in rest:
            rest[seed] -= 1
        used = fill(rest, window - seed)
        used[seed] = used.get(seed, 0) + 1
        times = min(left[k] // m for k, m in used.items())
        out.append((used, times))
        for k, m in used.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
    return out


def pack(docs: DataFrame, window: int = WINDOW, vocab: str | None = None) -> DataFrame:
    """All pieces with their sequence and their offset in it."""
    spark = docs.sparkSession
    cut = saved(pieces(docs, window, vocab), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= window rows
    entries: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for used, times in plan(histogram, window):
        offset = 0
        for length in sorted(used, reverse=True):
            first = ranks.get(length, 0)
            ranks[length] = first + used[length] * times
            entries.setdefault(length, []).append(
                (first, ranks[length], used[length], sequence, offset))
            offset += length * used[length]
        sequence += times
    schema = ("p_length long, uses array<struct<first:long, past:long, copies:long, "
              "sequence:long, offset:long>>")
    # one row a length, so never more than the window has tokens
    uses = F.broadcast(spark.createDataFrame(list(entries.items()), schema))
    ranked = numbered(cut, ["length"], ["doc_id", "start"],
                      ["doc_id", "start", "ids_crc32"], "__rank")
    use = F.element_at(F.filter(
        "uses", lambda u: (u["first"] <= F.col("__rank")) & (F.col("__rank") < u["past"])), 1)
    placed = ranked.join(uses, F.col("length") == F.col("p_length")).withColumn("__use", use)
    at = F.col("__rank") - F.col("__use.first")
    copies = F.col("__use.copies")
    return placed.select(
        *PIECES.fieldNames(),
        (F.col("__use.sequence") + F.floor(at / copies)).cast("long").alias("sequence_id"),
        (F.col("__use.offset") + F.pmod(at, copies) * F.col("length")).cast("long").alias("offset"))
