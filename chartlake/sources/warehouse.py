"""Warehouse tables on a file system: partitioned, idempotent snapshots.

Layout: ``<root>/<table>/source=<s>/snapshot_time=<t>/part-*.parquet``.

* a load writes whole snapshots with dynamic partition overwrite and removes
  the partitions of those snapshots that have no rows any more, so a rerun
  replaces exactly its own snapshots (idempotent);
* parents are written before children (artists, tracks, genres);
* "delete a snapshot" drops partition folders - metadata only, no data read;
* row-level rewrites (upsert, delete by keys) are staged to the shared
  checkpoint folder first and then swapped in, so a job never overwrites a
  path it is still reading; a note beside the table lets the next rewrite or
  load finish a swap that was cut short.

A root that has a catalogue (:mod:`chartlake.sources.published`; every load
makes one) is read and changed through it by the same functions.
"""

from __future__ import annotations

import os
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import schemas
from chartlake.functions.time import parse_iso, round_to_hour
from chartlake.session import staging_path

PARTITIONS = ["source", "snapshot_time"]
WRITE_ORDER = ["artists", "tracks", "track_genres"]
DELETE_ORDER = ["track_genres", "tracks", "artists"]


def table_path(root: str, table: str) -> str:
    return os.path.join(root, table)


def _catalogued(spark: SparkSession, root: str):
    """The functions for published tables, if ``root`` is a published warehouse."""
    from chartlake.sources import published
    return published if published.exists(spark, root) else None


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Scan a warehouse table with its declared schema."""
    published = _catalogued(spark, root)
    if published:
        return published.read(spark, root, table)
    path = table_path(root, table)
    st = schemas.WAREHOUSE[table]
    # partition columns come back last; restore the declared order
    return spark.read.schema(st).parquet(path).select(*st.fieldNames())


def check_schema(df: DataFrame, table: str) -> None:
    """Assert that every declared column is there with a type that widens to
    the declared one, so a drifted frame fails before anything is written."""
    wider = {("int", "bigint"), ("smallint", "bigint"), ("tinyint", "bigint"), ("date", "timestamp_ntz"),
             ("timestamp", "timestamp_ntz")}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}"
             for f in schemas.WAREHOUSE[table].fields
             if have.get(f.name) not in (f.dataType.simpleString(), "void")
             and (have.get(f.name), f.dataType.simpleString()) not in wider]
    if wrong:
        raise ValueError(f"{table} doesn't have its declared schema: {'; '.join(wrong)}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns by *name*, cast to the declared types."""
    st = schemas.WAREHOUSE[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])


def ready(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's declared form; a row without a snapshot fails the job that runs it."""
    check_schema(df, table)
    lost = F.raise_error(F.lit(f"{table}: a row has no snapshot time")).cast("timestamp_ntz")
    return conform(df, table).withColumn("snapshot_time", F.coalesce("snapshot_time", lost))


def write_snapshot(df: DataFrame, root: str, table: str, snapshot_time=None,
                   n_files: int | None = None, partition_by: Sequence[str] = PARTITIONS,
                   mode: str = "replace") -> None:
    """Write one table's rows of one (or several) snapshots.

    ``mode="replace"`` replaces the partitions the rows fall into,
    ``mode="append"`` adds to them. A row without a snapshot fails the write:
    its partition could neither be read nor replaced.

    ``snapshot_time`` stamps every row with the hour-rounded run time (taken
    from the run parameter, never from the wall clock).

    No shuffle by default: each task writes its rows, sorted by partition
    and key columns (tight parquet min/max statistics), into the folders they
    belong to. Repartitioning by the partition columns would send a whole
    run - every row of one snapshot shares them - to a single writer task.
    ``n_files`` bounds the files per folder instead: rows are hashed on the
    partition columns *plus* a key-derived salt in ``[0, n_files)``, so each
    folder is written by at most ``n_files`` tasks and a hot folder is split
    ``n_files`` ways.
    """
    if snapshot_time is not None:
        df = df.withColumn("snapshot_time", round_to_hour(parse_iso(F.lit(str(snapshot_time)))))
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be replace or append, not {mode!r}")
    published = _catalogued(df.sparkSession, root)
    if published:
        published.publish(df.sparkSession, root, {table: df}, n_files=n_files,
                          kind=published.ADD if mode == "append" else published.REPLACE)
        return
    df = ready(df, table)
    parts = list(partition_by)
    keys = list(schemas.KEYS[table])
    if n_files:
        salt = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(int(n_files)))
        df = df.repartition(*[F.col(p) for p in parts], salt)
    df = df.sortWithinPartitions(*parts, *keys)
    (df.write.mode("append" if mode == "append" else "overwrite").partitionBy(*parts)
       .option("partitionOverwriteMode", "dynamic")
       .parquet(table_path(root, table)))


def drop_stale(spark: SparkSession, root: str, table: str, fresh: DataFrame, source: str,
               snapshots: DataFrame) -> list[str]:
    """Remove partitions of ``source`` at ``snapshots`` (snapshot_time) that hold
    no row of ``fresh`` any more. Compares partition names, not table rows."""
    spark_rows = _partition_frame(spark, _list_partitions(spark, table_path(root, table)))
    if spark_rows is None:
        return []
    held = fresh.where(F.col("source") == source).select("snapshot_time").distinct()
    stale = (spark_rows.where(F.col("source") == source)
             .join(snapshots.select("snapshot_time").distinct(), "snapshot_time", "left_semi")
             .join(held, "snapshot_time", "left_anti"))
    return _remove(spark, root, table, [r.rel for r in stale.select("rel").collect()])


def _remove(spark: SparkSession, root: str, table: str, rels: Sequence[str]) -> list[str]:
    for rel in sorted(rels):
        fs, p = _fs(spark, os.path.join(table_path(root, table), rel))
        fs.delete(p, True)
    return sorted(rels)


def load_snapshot(root: str, tracks: DataFrame, artists: DataFrame, genres: DataFrame,
                  snapshot_time=None, n_files: int | None = None) -> None:
    """Ordered load: artists, then tracks, then genres (parents first)."""
    frames = {"artists": artists, "tracks": tracks, "track_genres": genres}
    published = _catalogued(tracks.sparkSession, root)
    if published and snapshot_time is None:
        published.publish(tracks.sparkSession, root, frames, n_files=n_files)
        return
    for t in WRITE_ORDER:
        write_snapshot(frames[t], root, t, snapshot_time, n_files)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _partition_dir(root: str, table: str, source: str, at: str) -> str:
    from urllib.parse import quote
    t = str(at)
    if len(t) == 10:
        t += " 00:00:00"
    # Spark escapes ':' in partition values
    return os.path.join(table_path(root, table), f"source={source}",
                        f"snapshot_time={quote(t, safe=' -')}")


def drop_snapshot(spark: SparkSession, root: str, at, source: str,
                  tables: Sequence[str] = DELETE_ORDER) -> list[str]:
    """Delete one snapshot of one source from every table - children first -
    by removing partition folders. Returns the folders removed."""
    published = _catalogued(spark, root)
    if published:
        instant = F.lit(str(at)).cast("timestamp_ntz")
        return published.drop(spark, root, (F.col("source") == source) & (F.col("snapshot_time") == instant), tables)
    removed = []
    for t in tables:
        d = _partition_dir(root, t, source, at)
        fs, p = _fs(spark, d)
        if fs.exists(p):
            fs.delete(p, True)
            removed.append(d)
    return removed


def rewrite_table(spark: SparkSession, root: str, table: str,
                  fn: Callable[[DataFrame], DataFrame], where=None) -> None:
    """Apply a row-level rewrite (upsert, delete by keys) to a table.

    ``where`` is a predicate on the partition columns (``source``,
    ``snapshot_time``) naming the partitions the change may touch; only those
    are read (partition pruning), rewritten and swapped - the rest of the
    table is never scanned. Without it the whole table is rewritten.

    The new content is first written to a staging folder under the shared
    checkpoint dir (cutting the lineage to the files being replaced). A note
    beside the table then names that folder and the touched partitions; only
    now are these overwritten from the staged copy, and those that became
    empty removed (dynamic overwrite would leave them in place). If the job
    dies meanwhile, the next rewrite finds the note and finishes it first.
    """
    published = _catalogued(spark, root)
    if published:
        published.rewrite(spark, root, table, fn, where)
        return
    finish_rewrite(spark, root, table)
    current = read_table(spark, root, table)
    target = table_path(root, table)
    touched = _list_partitions(spark, target)
    if where is not None:
        current = current.where(where)
        touched = _matching_partitions(spark, touched, where)
    stage = staging_path(spark, table)
    conform(fn(current), table).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(stage)
    note = spark.createDataFrame([(stage, sorted(touched))], NOTE)
    note.coalesce(1).write.mode("overwrite").parquet(_note_path(root, table))
    finish_rewrite(spark, root, table)


NOTE = "stage string, touched array<string>"


def _note_path(root: str, table: str) -> str:
    return os.path.join(root, "_rewrites", table)


def finish_rewrite(spark: SparkSession, root: str, table: str) -> bool:
    """Swap in a staged rewrite that has a complete note; True if there was one.

    Every step can be repeated: the overwrite from the staged copy, the
    removal of emptied partitions, and last the removal of note and copy.
    """
    note_path = _note_path(root, table)
    fs, done = _fs(spark, os.path.join(note_path, "_SUCCESS"))
    if not fs.exists(done):
        return False
    note = spark.read.schema(NOTE).parquet(note_path).first()
    staged = spark.read.schema(schemas.WAREHOUSE[table]).parquet(note.stage)
    staged.write.mode("overwrite").partitionBy(*PARTITIONS) \
        .option("partitionOverwriteMode", "dynamic").parquet(table_path(root, table))
    _remove(spark, root, table, [r for r in set(note.touched) - _list_partitions(spark, note.stage) if r])
    fs.delete(done, False)  # from here on the note counts as finished
    for path in (note_path, note.stage):
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return True


def _matching_partitions(spark: SparkSession, rels: set[str], where) -> set[str]:
    """Partition folders whose values satisfy ``where``.

    Evaluated by Spark on a frame of the folder *names* (one row per
    partition - metadata, not table rows).
    """
    df = _partition_frame(spark, rels)
    return set() if df is None else {r.rel for r in df.where(where).select("rel").collect()}


def _partition_frame(spark: SparkSession, rels: set[str]) -> DataFrame | None:
    """(rel, source, snapshot_time) of partition names; NULL time for a default partition."""
    from urllib.parse import unquote
    if not rels:
        return None
    recs = []
    for rel in sorted(rels):
        vals = dict(kv.split("=", 1) for kv in rel.split("/"))
        recs.append((rel, unquote(vals["source"]), unquote(vals["snapshot_time"])))
    return spark.createDataFrame(recs, "rel string, source string, t string").select(
        "rel", "source", F.col("t").try_cast("timestamp_ntz").alias("snapshot_time"))


def _list_partitions(spark: SparkSession, path: str) -> set[str]:
    fs, p = _fs(spark, path)
    out = set()
    if not fs.exists(p):
        return out
    for s in fs.listStatus(p):
        if s.isDirectory() and "=" in s.getPath().getName():
            for s2 in fs.listStatus(s.getPath()):
                if s2.isDirectory() and "=" in s2.getPath().getName():
                    out.add(f"{s.getPath().getName()}/{s2.getPath().getName()}")
    return out
