"""Weighted rendezvous hashing of record keys over shards.

Every (key, shard) pair has a score ``-weight / ln(u)`` with ``u`` a 64-bit
hash of shard label and key mapped into (0, 1); the record goes to the shard
with the highest score. A shard's scores don't depend on the other shards, so
one more shard takes records only into itself, one less only gives its own
away, and shares follow the weights. Only built-in functions run.

Defined results: a null key is one more key value (all rows with it share a
shard, but not a numbering task); texts play no part in the choice; repeated
rows land together; an empty table stays empty; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered

#: A shard: its lasting label and its weight.
Shard = tuple[str, float]


def equal_shards(n: int) -> list[Shard]:
    return [(f"shard-{i}", 1.0) for i in range(n)]


def rendezvous(key: Column, shards: Sequence[Shard]) -> Column:
    """Index in ``shards`` of the shard with the highest score for ``key``."""
    if not shards or any(w <= 0 for _, w in shards) or len({s for s, _ in shards}) < len(shards):
        raise ValueError("shards need distinct labels and positive weights")
    scores = []
    for i, (label, weight) in enumerate(shards):
        h = F.shiftrightunsigned(F.xxhash64(F.lit(label), key), 11)
        u = (h.cast("double") + 0.5) / float(2 ** 53)
        # the lower index wins should two scores be equal
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"),
                               F.lit(-i).alias("neg")))
    best = F.array_max(F.array(*scores))
    return (-best["neg"]).cast("int")


def assign(df: DataFrame, key: str, shards: Sequence[Shard], column: str = "shard") -> DataFrame:
    return df.withColumn(column, rendezvous(F.col(key), shards))


def with_slots(df: DataFrame, spread: list[str], shard: str = "shard", slot: str = "slot",
               buckets: int = 4096) -> DataFrame:
    """Each row's place in its shard, gapless from 0; see :func:`.common.numbered`."""
    return numbered(df, [shard], spread, spread, slot, buckets)
