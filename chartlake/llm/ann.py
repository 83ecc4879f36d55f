"""Nearest neighbours by stable projections, kd-trees and a chi-square test.

Largest inner product becomes least Euclidean distance by one more component,
sqrt(M^2 - |x|^2) with M the largest norm (0 for queries). Vectors are projected
on ``DIMENSIONS`` fixed Gaussian directions; for such a projection the squared
projected distance over the squared distance is chi-square distributed with
that many degrees of freedom. Each part of the index is a kd-tree over the
projected vectors, stored as a table of leaves with their boxes. A query takes
the leaves from the nearest box on and verifies their vectors exactly, until
the next box is so far away that a vector nearer than its k-th best so far
would be projected that far only with probability 1 - ``CERTAINTY``.

All vectors are indexed. Equal vectors are one entry with its k + 1 smallest
ids, which suffices for any k nearest with ties to smaller ids. Queries and
index meet block by block, both blocks of bounded size, whatever their number.

Defined results: vectors that are null, zero, hold null or non-finite
components, or aren't of the most frequent length take no part; equal scores
go to the smaller id; a query finds every other row with its own vector;
repeated rows with one id are one row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

DIMENSIONS, CERTAINTY, SEED = 8, 0.96, 20
LEAF, PART, BLOCK = 128, 16_384, 2_048


def chi_square(x: float, freedom: int) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_at(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (low, mid) if chi_square(mid, freedom) >= share else (mid, high)
    return high


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vectors take part, with the vector as doubles."""
    v = F.col(vector)
    fine = (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = df.where(F.coalesce(fine, F.lit(False))).withColumn(vector, v.cast("array<double>"))
    sizes = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size(vector) == (first["d"] if first else 0))


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, DIMENSIONS))


def leaves(points: np.ndarray, at: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The leaves of a kd-tree: halves along the widest side until they are small."""
    at = np.arange(len(points)) if at is None else at
    if len(at) <= LEAF:
        yield at
        return
    side = int(np.ptp(points[at], axis=0).argmax())
    half = len(at) // 2
    order = np.argpartition(points[at, side], half)
    yield from leaves(points, at[order[:half]])
    yield from leaves(points, at[order[half:]])


def build(df: DataFrame, key: str, vector: str, k: int) -> tuple[DataFrame, float, int, int]:
    """The stored index (part, leaf, ids, v, low, high), the largest norm, the dimension, the parts."""
    ranked = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    distinct = saved(ranked.where(F.col("rank") <= k + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "vectors")  # at most k + 1 ids
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("m"), F.max(F.size("v")).alias("d")).first()
    parts, top, dim = max(1, -(-size["n"] // PART)), math.sqrt(size["m"] or 0.0), size["d"] or 1

    def tree(t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        rest = np.sqrt(np.maximum(top * top - (v * v).sum(axis=1), 0.0))
        points = np.column_stack([v, rest]) @ directions(dim + 1)
        ids = t.column("ids").combine_chunks()
        part = t.column("part")[0].as_py()
        rows = [(part, i, ids.take(pa.array(at)).to_pylist(), v[at].ravel(), points[at].min(axis=0),
                 points[at].max(axis=0)) for i, at in enumerate(leaves(points))]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.list_(ids.type.value_type)), *[pa.list_(pa.float64())] * 3]
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(
            ["part", "leaf", "ids", "v", "low", "high"], zip(*rows), kinds)})

    kind = df.schema[key].dataType.simpleString()
    dealt = distinct.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int"))
    index = dealt.groupBy("part").applyInArrow(
        tree, f"part int, leaf int, ids array<array<{kind}>>, v array<double>, low array<double>, high array<double>")
    return saved(index, "kd-leaves"), top, dim, parts


def nearest_in(low: np.ndarray, high: np.ndarray, starts: np.ndarray, v: np.ndarray, queries: np.ndarray,
               points: np.ndarray, first: np.ndarray, top: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of the best k of ``v`` for each query, -inf and -1 where there are fewer.

    ``first``: the smallest id of each vector.
    """
    limit = chi_square_at(CERTAINTY, DIMENSIONS)
    gap = np.zeros((len(queries), len(low)))
    for j in range(points.shape[1]):
        d = np.maximum(np.maximum(low[None, :, j] - points[:, None, j], points[:, None, j] - high[None, :, j]), 0)
        gap += d * d
    order = np.argsort(gap, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    place = np.full((len(queries), k), -1)
    base = (queries * queries).sum(axis=1) + top * top
    active = np.arange(len(queries))
    for step in range(len(low)):
        leaf = order[active, step]
        reach = limit * np.maximum(base[active] - 2 * best[active].min(axis=1), 0)  # inf until k are found
        go = gap[active, leaf] < reach
        go |= np.isinf(reach)
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        by = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(leaf[by]) != 0, [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            q, x = active[by[a:b]], leaf[by[a]]
            at = np.arange(starts[x], starts[x + 1])
            scores = np.concatenate([best[q], queries[q] @ v[at].T], axis=1)
            places = np.concatenate([place[q], np.broadcast_to(at, (len(q), len(at)))], axis=1)
            keep = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            last = np.take_along_axis(scores, keep, 1).min(axis=1)
            for i in np.flatnonzero((scores >= last[:, None]).sum(axis=1) > k):  # ties go to the smaller first id
                keep[i] = np.lexsort((first[places[i]], -scores[i]))[:k]
            best[q], place[q] = np.take_along_axis(scores, keep, 1), np.take_along_axis(places, keep, 1)
    return best, place


def search(index: DataFrame, top: float, dim: int, parts: int, queries: DataFrame, key: str, vector: str,
           k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, its own row aside."""
    rows = queries.select(F.col(key).alias("id"), F.col(vector).alias("q")).distinct()
    blocks = max(1, -(-rows.count() // BLOCK))
    asked = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = left.schema.field("ids").type.value_type
        ids = [x for row in left.column("ids").to_pylist() for x in row]
        out: tuple[list, list, list] = ([], [], [])
        if len(ids) and right.num_rows:
            starts = np.concatenate([[0], np.cumsum([len(x) for x in left.column("ids").to_pylist()])])
            v = left.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            low, high = (left.column(c).combine_chunks().flatten().to_numpy().reshape(-1, DIMENSIONS)
                         for c in ("low", "high"))
            q = right.column("q").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            points = np.column_stack([q, np.zeros(len(q))]) @ directions(dim + 1)
            _, place = nearest_in(low, high, starts, v, q, points, np.array([x[0] for x in ids]), top, k + 1)
            for i, query in enumerate(right.column("id").to_pylist()):
                found = place[i][place[i] >= 0]
                for at, score in zip(found, (q[i] * v[found]).sum(axis=1)):
                    out[0].append(query)
                    out[1].append(ids[at])
                    out[2].append(score)
        return pa.table({"query_id": pa.array(out[0], right.schema.field("id").type),
                         "ids": pa.array(out[1], kind), "score": pa.array(out[2], pa.float64())})

    kind = rows.schema["id"].dataType.simpleString()
    met = held.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInArrow(
        meet, f"query_id {kind}, ids array<{index.schema['ids'].dataType.elementType.elementType.simpleString()}>, "
              "score double")
    each = met.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding",
            k: int = 20) -> DataFrame:
    """The k nearest other rows of each row where ``queries`` holds."""
    rows = usable(df.where(F.col(key).isNotNull()), vector)
    index, top, dim, parts = build(rows, key, vector, k)
    return search(index, top, dim, parts, rows.where(queries), key, vector, k)
