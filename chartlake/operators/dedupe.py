"""Deterministic deduplication.

``dropDuplicates`` keeps an arbitrary survivor, so two runs (or two uses of
one plan) can disagree. ``dedupe_latest`` keeps the first row of each key
under a *total* order. Written as ``row_number() ... = 1`` so Catalyst plans a
partial ``WindowGroupLimit`` before the shuffle: each map task forwards at
most one row per key, which keeps a hot key (a third of all rows) from
flooding one reducer.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(df: DataFrame, order_by: Sequence) -> list[Column]:
    cols = []
    for o in order_by:
        cols.append(F.col(o) if isinstance(o, str) else o)
    return cols


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence | None = None,
                  tie_break: bool = True) -> DataFrame:
    """One row per ``keys`` (NULL keys collapse into one group, as in GROUP BY).

    ``order_by`` decides the survivor (first row wins); when ``tie_break`` is
    on, every remaining column is appended ascending so equal-ordered rows
    still resolve the same way on every run.
    """
    order = _order(df, order_by or [])
    if tie_break:
        used = set(keys)
        for o in order_by or []:
            if isinstance(o, str):
                used.add(o)
        order += [F.col(c).asc_nulls_last() for c in df.columns
                  if c not in used and _orderable(df, c)]
    if not order:
        order = [F.lit(1)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def _mark(keys: Sequence[str]) -> Column:
    """40 bits of the keys' hash: equal keys have equal marks (no floating-point or collated keys)."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 24)


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(mark)`` of every key that several rows of ``df`` have, and of a few others by chance."""
    return (df.select(_mark(keys).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") > 1).select("mark"))


def dedupe_repeated(df: DataFrame, marks: DataFrame, keys: Sequence[str], order_by: Sequence | None = None,
                    tie_break: bool = True) -> DataFrame:
    """The rows of :func:`dedupe_latest` where few keys repeat: the rows whose key has none of
    ``marks``, which :func:`repeated` found and the caller stored, stay where they are; the
    others alone are shuffled. With few marks Spark broadcasts them; many cost a join more.
    """
    same = _mark(keys) == F.col("mark")
    return df.join(marks, same, "left_anti").unionByName(
        dedupe_latest(df.join(marks, same, "left_semi"), keys, order_by, tie_break))


def _orderable(df: DataFrame, c: str) -> bool:
    from pyspark.sql import types as T
    return not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))

