"""Raw landing zone: chart and artist documents stamped with their run.

On disk: ``<root>/<collection>/`` holding parquet (default) or JSON-lines
files; production landings are partitioned by ``data_time`` so a run filter
is a partition filter. Reads always use the declared schema (no inference),
so a new field is ignored; a JSON document that doesn't fit the schema is kept
apart (:func:`corrupt`) instead of becoming a document of NULLs.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.schemas import RAW
from chartlake.session import shuffles_go

CORRUPT = "_corrupt_record"
RUN_FOLDER = "data_time="


def collection_path(root: str, collection: str) -> str:
    return os.path.join(root, collection)


def run_folders(spark: SparkSession, root: str, collection: str) -> dict[str, str] | None:
    """Run stamp -> folder of a collection that is partitioned by run, else None.

    One listing of folder names; no file is listed or opened.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(collection_path(root, collection))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []
    found = {unquote(n[len(RUN_FOLDER):]): n for n in names if n.startswith(RUN_FOLDER)}
    return found or None


def read_runs(spark: SparkSession, root: str, collection: str, runs: DataFrame, stamped: Column,
              fmt: str = "parquet", schema=None) -> DataFrame:
    """The documents whose ``stamped`` (an expression of ``data_time``) is a value of ``runs``' only column.

    On a landing partitioned by run the stamps are taken from the folder
    names first; only the folders that fit are listed and read, and their
    stamps stand in the scan's partition filter. On any other landing the
    documents are semi-joined after the scan.
    """
    wanted = runs.select(F.col(runs.columns[0]).alias("__at")).distinct()
    folders = run_folders(spark, root, collection)
    if folders is None:
        docs = read_raw(spark, root, collection, fmt=fmt, schema=schema)
        return docs.join(wanted, stamped == F.col("__at"), "left_semi")
    names = spark.createDataFrame([(stamp,) for stamp in folders], "data_time string")
    fit = sorted(r.data_time for r in names.join(wanted, stamped == F.col("__at"), "left_semi").collect())
    df = _scan(spark, root, collection, fit, fmt, schema, [folders[stamp] for stamp in fit])
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if fmt == "json" else df


def read_raw(spark: SparkSession, root: str, collection: str, runtime: str | None = None,
             fmt: str = "parquet", schema=None) -> DataFrame:
    """Scan one landing collection; ``runtime`` keeps only that run.

    The run filter is a plain ``where`` on ``data_time``: on a landing
    partitioned by ``data_time`` Catalyst turns it into a partition filter,
    otherwise into a pushed parquet filter.
    """
    df = _scan(spark, root, collection, None if runtime is None else [runtime], fmt, schema)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if fmt == "json" else df


def corrupt(spark: SparkSession, root: str, collection: str, runtime: str | None = None,
            schema=None) -> DataFrame:
    """``(data_time, _corrupt_record)`` of the JSON documents that don't fit the schema."""
    df = _scan(spark, root, collection, None if runtime is None else [runtime], "json", schema)
    return df.where(F.col(CORRUPT).isNotNull()).select("data_time", CORRUPT)


def _scan(spark: SparkSession, root: str, collection: str, runs: list[str] | None, fmt: str,
          schema, folders: list[str] | None = None) -> DataFrame:
    """The documents of ``runs`` (None: of all), read from ``folders`` of the collection if given."""
    schema = schema or RAW[collection]
    path = collection_path(root, collection)
    if folders == []:
        whole = T.StructType([*schema.fields, *([T.StructField(CORRUPT, T.StringType())] if fmt == "json" else [])])
        return spark.createDataFrame([], whole)
    paths = [path] if folders is None else [os.path.join(path, f) for f in folders]
    if fmt == "json":
        # one document a line, parsed with the text kept where it doesn't fit
        text = spark.read.option("basePath", path).text(paths)
        whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        doc = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        df = text.where(F.trim("value") != "").withColumn("doc", doc)
        run = F.col("doc.data_time")
        if "data_time" in text.columns:  # a landing partitioned by run
            run = F.coalesce(F.col("data_time").cast("string"), run)
        df = df.select(*[run.alias("data_time") if f == "data_time" else F.col(f"doc.{f}")
                         for f in whole.fieldNames()])
    else:
        df = spark.read.schema(schema).format(fmt).option("basePath", path).load(paths)
    if runs is not None:
        one = F.col("data_time")
        df = df.where(one == F.lit(runs[0]) if len(runs) == 1 else one.isin(runs))
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Empty-run guard: fail fast when a run landed nothing.

    ``isEmpty`` stops at the first row found (a LIMIT 1 job), it does not
    count the input.
    """
    if df.isEmpty():
        raise RuntimeError(f"Cannot fetch {what} data")
    return df


def land(df: DataFrame, root: str, collection: str, runtime: str | None = None,
         fmt: str = "parquet", partition_by_run: bool = True,
         max_records_per_file: int | None = None, mode: str | None = None) -> None:
    """Write documents to the landing zone, stamped with their run.

    One distributed write (no driver-side batching); with
    ``partition_by_run`` each run lands in its own ``data_time=...`` folder.
    ``mode="append"`` adds to what a run has landed so far (batches, late
    pages; a document landed twice is folded by the transforms' keys).
    ``mode="replace"`` is for a run fetched again as a whole: the folders of
    the runs in ``df`` are replaced, all others stay, whatever the session's
    overwrite setting. The default is to replace where runs have folders.
    """
    mode = mode or ("replace" if partition_by_run else "append")
    if mode not in ("append", "replace") or (mode == "replace" and not partition_by_run):
        raise ValueError("mode is append, or replace for a landing partitioned by run")
    if runtime is not None:
        df = df.withColumn("data_time", F.lit(runtime))
    w = df.write.format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by_run:
        w = w.partitionBy("data_time")
    if mode == "replace":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    with shuffles_go(df.sparkSession):
        w.save(collection_path(root, collection))
