"""Helpers shared by the operators: saved tables, measured broadcasts, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake.session import shuffles_go, staging_path

#: Rows up to which a side whose rows have just been counted is broadcast.
BROADCAST_ROWS = 200_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts lineage: what was computed survives the loss of any executor and is
    not computed again by later jobs.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    with shuffles_go(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, counted now.

    Larger tables come back as they are, for Spark to shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def id_key(column: Column) -> Column:
    """A join key that treats a null id as one more value."""
    return F.coalesce(column.cast("string"), F.lit("\u0000"))


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """``docs`` with a ``__key`` for each row, and whether the rows had to be numbered for it.

    The key is the id if it tells all rows apart. Otherwise rows are numbered
    in the order of their ids, null last; equal rows are spread by their
    place, so a group of copies isn't sorted in one task, and the numbers are
    stored, so every later job reads the same.
    """
    ids = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if ids.where((F.col("n") > 1) | F.col(id_col).isNull()).isEmpty():
        return docs.withColumn("__key", F.col(id_col)), False
    place = docs.withColumn("__place", F.monotonically_increasing_id())
    ordered = place.orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64("text"), "__place")
    return saved(ordered.drop("__place").withColumn("__key", F.monotonically_increasing_id()), "keyed"), True


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder``.

    A null id counts as the empty text.
    """
    return (unsigned_crc32(doc_id.cast("string")) % modulus) == remainder


def numbered(df: DataFrame, groups: list[str], spread: list[str], order: list[str],
             name: str, buckets: int = 1024) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without one task per group.

    Rows are dealt by ``(groups, hash bucket of spread)``. The counts of these
    small pieces (groups x buckets rows, whatever the data size) give each
    piece its first number; inside a piece the rows are counted in ``order``.
    Rows equal in every column of ``order`` are numbered in any order.
    """
    piece = F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int")
    rows = df.withColumn("__piece", piece)
    counts = rows.groupBy(*groups, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = counts.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.col("__piece").alias("__p"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(*groups, "__piece").orderBy(*order)
    on = [F.col(g) == F.col(f"__g{i}") for i, g in enumerate(groups)]
    out = rows.withColumn("__rn", F.row_number().over(inside) - 1).join(
        firsts, [*on, F.col("__piece") == F.col("__p")])
    return out.withColumn(name, (F.col("__first") + F.col("__rn")).cast("long")).drop(
        "__piece", "__p", "__first", "__rn", *[f"__g{i}" for i in range(len(groups))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
