"""Data-quality rules: the warehouse constraints as DataFrame checks.

A rule is ``name -> Column`` that is TRUE when a row *violates* it. A rule
that evaluates to NULL counts as passed (like a SQL CHECK constraint).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake import schemas as S


def _viol(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def check(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (good rows, rejected rows + ``failed_rules`` array)."""
    names = list(rules)
    failed = F.filter(
        F.array(*[F.when(_viol(rules[n]), F.lit(n)) for n in names]),
        lambda x: x.isNotNull())
    tagged = df.withColumn("failed_rules", failed)
    good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    rejected = tagged.where(F.size("failed_rules") > 0)
    return good, rejected


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, violations)`` for every rule - zero counts included.

    One scan, one partial/final aggregate (a single row per map task), then
    unpivoted with ``stack``.
    """
    names = list(rules)
    aggs = [F.sum(F.when(_viol(rules[n]), 1).otherwise(0)).cast("bigint").alias(f"r{i}")
            for i, n in enumerate(names)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', coalesce(r{i}, 0L)" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (rule, violations)")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, nulls)`` for the required columns (one pass)."""
    return rule_counts(df, {c: F.col(c).isNull() for c in cols}).withColumnRenamed(
        "rule", "column").withColumnRenamed("violations", "nulls")


def fk_orphans(child: DataFrame, parent: DataFrame, on: Sequence[str] | dict) -> DataFrame:
    """Child rows whose key has no parent row (NULL keys are not orphans)."""
    if isinstance(on, dict):
        pairs = list(on.items())
    else:
        pairs = [(k, k) for k in on]
    # no distinct: repeated parent keys don't matter to an anti-join, and AQE can split it
    pk = parent.select(*[F.col(p).alias(f"__p_{i}") for i, (_, p) in enumerate(pairs)])
    cond = None
    notnull = None
    for i, (c, _) in enumerate(pairs):
        e = child[c] == pk[f"__p_{i}"]
        cond = e if cond is None else cond & e
        nn = F.col(c).isNotNull()
        notnull = nn if notnull is None else notnull & nn
    return child.where(notnull).join(pk, cond, "left_anti")


# --- the reference warehouse's declared constraints ---------------------------

def artist_rules() -> dict[str, Column]:
    return {
        "artist_id_too_long": F.length("artist_id") > S.ID_MAX_LEN,
        "name_too_long": F.length("name") > S.NAME_MAX_LEN,
        "source_null": F.col("source").isNull(),
        "source_too_long": F.length("source") > S.SOURCE_MAX_LEN,
        "followers_negative": F.col("total_followers") < 0,
        "followers_overflow": F.col("total_followers") > S.UNSIGNED_INT_MAX,
    }


def track_rules() -> dict[str, Column]:
    return {
        "track_id_null": F.col("track_id").isNull(),
        "track_id_too_long": F.length("track_id") > S.ID_MAX_LEN,
        "name_too_long": F.length("name") > S.NAME_MAX_LEN,
        "source_null": F.col("source").isNull(),
        "release_date_null": F.col("release_date").isNull(),
        "duration_negative": F.col("duration") < 0,
        "popularity_negative": F.col("popularity") < 0,
        "artist_id_too_long": F.length("artist_id") > S.ID_MAX_LEN,
    }


def genre_rules() -> dict[str, Column]:
    return {
        "track_id_null": F.col("track_id").isNull(),
        "genre_null": F.col("genre").isNull(),
        "genre_too_long": F.length("genre") > S.GENRE_MAX_LEN,
    }


# Fields every API result row must carry.
REQUIRED_TRACK_FIELDS = ["source", "track_id", "artist_id", "name", "release_date", "chart_date"]
