"""SparkSession settings the engine relies on.

* UTC session time zone: ISO texts with offsets are parsed to instants and
  stored as zone-less ``timestamp_ntz`` wall times in UTC.
* ANSI stays on (Spark 4 default); the engine uses ``try_*`` / ``get`` where
  input may be dirty.
* AQE with skew-join splitting and partition coalescing, so join strategy
  (broadcast vs. sort-merge) is chosen from *measured* sizes at run time.
* Dynamic partition overwrite, so rewriting a snapshot touches only its own
  partitions.
* No web UI.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of whole texts: a batch is in the memory of the JVM and of a worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_session(master: str | None = None, app: str = "chartlake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the SQL-level settings on an existing session (e.g. the driver's)."""
    for k, v in ENGINE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


#: Parquet of a task that reads landed documents or stored facts: they hold twenty
#: times and more of it in memory, where the first sort of a task has to find room.
STORED_SPLIT = "32m"
SPLIT = "spark.sql.files.maxPartitionBytes"
#: How landed documents and stored facts are compressed: they are written once and are most of what a build writes.
STORED_CODEC = "zstd"
CODEC = "spark.sql.parquet.compression.codec"
_OWN: dict[str, dict[str, str | None]] = {}


def read_stored(spark: SparkSession, stored: bool) -> None:
    """Small scan tasks and dense files for queries over the landing and the warehouse; else the session's own."""
    app = spark.sparkContext.applicationId
    if stored:
        _OWN.setdefault(app, {k: spark.conf.get(k, None) for k in (SPLIT, CODEC)})
        spark.conf.set(SPLIT, STORED_SPLIT)
        spark.conf.set(CODEC, STORED_CODEC)
    else:
        for k, own in _OWN.pop(app, {}).items():
            spark.conf.unset(k) if own is None else spark.conf.set(k, own)


#: Whether a finished execution's shuffle files are removed at once, and not when the driver collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go(spark: SparkSession):
    """For a write of rows that are read back from what was written: its plan runs once, so at its
    end its shuffle files go, before the next step fills the disks with its own."""
    own = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if own is None else spark.conf.set(SHUFFLES_GO, own)


_LOCAL_BASE: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and stage rewrites.

    On a cluster this is ``spark.checkpoint.dir`` as the operator configured
    it (a shared file system); it is read from the session, never replaced.
    Only when it is unset and the master is local (tests) do we create one
    under the local temp folder, once per application; on a cluster that
    folder would be another one on every machine, so there it is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            d = None
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        app = sc.applicationId
        d = _LOCAL_BASE.get(app) or tempfile.mkdtemp(prefix="chartlake-ckpt-")
        _LOCAL_BASE[app] = d
    if sc.getCheckpointDir() is None:
        # used by DataFrame.checkpoint(); Spark adds its own sub-folder
        sc.setCheckpointDir(d)
    return d


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for staged rewrites."""
    import uuid
    return os.path.join(checkpoint_dir(spark), "staging", f"{name}-{uuid.uuid4().hex}")
