"""Write the twin landing zone and warehouse once, then serve reads from them.

This is the reference's own shape - land raw documents, transform them into
the warehouse, answer reads from the warehouse - run over the whole driver
tables. Both stages are written under the shared folder named by
``spark.checkpoint.dir`` (a lost executor cannot lose them, and they cut the
lineage of every later query), keyed by a fingerprint of the input files so a
changed input is rebuilt. A stage counts as present only when Spark's
``_SUCCESS`` marker is there; an interrupted write is simply redone.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.operators.dedupe import dedupe_repeated, repeated
from chartlake.plans import transform, twin
from chartlake.session import checkpoint_dir, shuffles_go, staging_path
from chartlake.sources import landing as L
from chartlake.sources import warehouse as W

_LOCK = threading.RLock()
INPUTS = ["orders", "lineitem", "part", "supplier", "customer", "nation", "region"]
BUILDERS = {
    "spotify_top_tracks": twin.spotify_top_tracks,
    "spotify_artists": twin.spotify_artists,
    "soundcloud_top_tracks": twin.soundcloud_top_tracks,
    "soundcloud_artists": twin.soundcloud_artists,
}
CHARTS = ("spotify_top_tracks", "soundcloud_top_tracks")
#: What this application built, for release().
_FP: dict[tuple[str, str], set[str]] = {}


def _fs(spark: SparkSession, path: str):
    return W._fs(spark, path)


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Hash of input paths, sizes and modification times (listing only), taken
    anew at every call: a changed input has another fingerprint."""
    # scoped to the application: each session builds (and reports) its own
    h = hashlib.sha1(f"{sf_dir}|{spark.sparkContext.applicationId}".encode())
    for t in INPUTS:
        fs, p = _fs(spark, f"{sf_dir}/{t}.parquet")
        st = fs.getFileStatus(p)
        size = fs.getContentSummary(p).getLength() if st.isDirectory() else st.getLen()
        h.update(f"{t}:{size}:{st.getModificationTime()}".encode())
    fp = h.hexdigest()[:16]
    _FP.setdefault((sf_dir, spark.sparkContext.applicationId), set()).add(fp)
    return fp


def _root(spark: SparkSession, sf_dir: str) -> str:
    return os.path.join(checkpoint_dir(spark), "chartlake-twin", fingerprint(spark, sf_dir))


def _done(spark: SparkSession, path: str, marker: str = "_SUCCESS") -> bool:
    fs, p = _fs(spark, os.path.join(path, marker))
    return bool(fs.exists(p))


def _mark(spark: SparkSession, path: str, marker: str = "_COMPLETE") -> None:
    fs, p = _fs(spark, os.path.join(path, marker))
    fs.create(p, True).close()


def _pages_path(spark: SparkSession, sf_dir: str) -> str:
    return os.path.join(_root(spark, sf_dir), "pages")


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paged order lines that feed the collections of both sources: written once to the
    shared folder, one row a page, where no lost executor costs them."""
    path = _pages_path(spark, sf_dir)
    with _LOCK:
        if not _done(spark, path):
            with shuffles_go(spark):
                twin.chart_pages(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _documents(spark: SparkSession, sf_dir: str, collection: str, alone: bool) -> DataFrame:
    build = BUILDERS[collection]
    if collection == "soundcloud_artists":
        return build(spark, sf_dir, raw(spark, sf_dir, "soundcloud_top_tracks", alone))
    if alone and collection in CHARTS and not _done(spark, _pages_path(spark, sf_dir)):
        return build(spark, sf_dir)
    return build(spark, sf_dir, chart_pages(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str, collection: str) -> DataFrame:
    """The rows of :func:`raw`; where they aren't landed yet they are made of the stored pages
    and not written, for a caller that lands them elsewhere."""
    root = os.path.join(_root(spark, sf_dir), "landing")
    if _done(spark, L.collection_path(root, collection)):
        return raw(spark, sf_dir, collection)
    pages = chart_pages(spark, sf_dir)
    return BUILDERS[collection](spark, sf_dir, twin.soundcloud_users(pages) if collection == "soundcloud_artists" else pages)


def landing_root(spark: SparkSession, sf_dir: str, *collections: str, alone: bool = False) -> str:
    """Landing zone with the raw collections named, by default all four (built when absent).

    ``alone`` is for a query that reads the charts of one source and needs the pages for
    nothing else: they aren't written for it, and its joins move that source's columns.
    """
    root = os.path.join(_root(spark, sf_dir), "landing")
    with _LOCK:
        for coll in collections or BUILDERS:
            path = L.collection_path(root, coll)
            if not _done(spark, path):
                docs = _documents(spark, sf_dir, coll, alone)
                with shuffles_go(spark):
                    docs.write.mode("overwrite").parquet(path)
    return root


def raw(spark: SparkSession, sf_dir: str, collection: str, alone: bool = False) -> DataFrame:
    return L.read_raw(spark, landing_root(spark, sf_dir, collection, alone=alone), collection)


def _source_path(root: str, table: str, source: str) -> str:
    return os.path.join(W.table_path(root, table), f"source={source}")


def _write_table(df: DataFrame, root: str, table: str, source: str) -> None:
    # Bulk load of every run at once: partitioned by source; rows sorted by
    # snapshot inside each task's file so parquet min/max statistics prune
    # runs. No extra shuffle: the transform's own shuffles spread the rows.
    df = W.conform(df, table)
    with shuffles_go(df.sparkSession):
        (df.sortWithinPartitions("snapshot_time", *W.schemas.KEYS[table]).drop("source")
           .write.mode("overwrite").parquet(_source_path(root, table, source)))


def _dedupe(df: DataFrame, keys: list, order_by: list) -> DataFrame:
    """One row a key of all runs at once, where a key seldom repeats: what repeats is
    found by hashes alone and written, and no other row is moved."""
    spark = df.sparkSession
    path = staging_path(spark, "repeated")
    with shuffles_go(spark):
        repeated(df, keys).write.mode("overwrite").parquet(path)
    return dedupe_repeated(df, spark.read.schema("mark long").parquet(path), keys, order_by)


def _facts(spark: SparkSession, sf_dir: str, table_name: str, source: str) -> DataFrame:
    """The rows of one table of one source; reads the collections it needs, no others."""
    def docs(collection: str) -> DataFrame:
        return raw(spark, sf_dir, f"{source}_{collection}")
    if source == transform.SPOTIFY:
        if table_name == "tracks":
            return transform.spotify_tracks(docs("top_tracks"), dedupe=_dedupe)
        if table_name == "artists":
            return transform.spotify_artists(docs("artists"), dedupe=_dedupe)
        # genres join the *written* tracks: the survivors of the dedupe are
        # read back, not recomputed, so genres always agree with tracks
        return transform.spotify_genres(table(spark, sf_dir, "tracks", source), docs("artists"), dedupe=_dedupe)
    if table_name == "tracks":
        return transform.soundcloud_tracks(docs("top_tracks"), dedupe=_dedupe)
    if table_name == "artists":
        return transform.soundcloud_artists(docs("artists"), raw_tracks=docs("top_tracks"), dedupe=_dedupe)
    return transform.soundcloud_genres(docs("top_tracks"))


def _stored(spark: SparkSession, sf_dir: str, table_name: str, source: str) -> str:
    """The warehouse's root, with one table of one source in it (built when absent)."""
    root = os.path.join(_root(spark, sf_dir), "warehouse")
    with _LOCK:
        if not _done(spark, _source_path(root, table_name, source)):
            _write_table(_facts(spark, sf_dir, table_name, source), root, table_name, source)
    return root


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    """Warehouse (artists, tracks, track_genres) of both sources; parents first."""
    for name in W.WRITE_ORDER:
        for source in (transform.SPOTIFY, transform.SOUNDCLOUD):
            root = _stored(spark, sf_dir, name, source)
    return root


def table(spark: SparkSession, sf_dir: str, name: str, source: str | None = None) -> DataFrame:
    """A warehouse table, or one source of it: what the query asks for is built, no more."""
    sources = (transform.SPOTIFY, transform.SOUNDCLOUD) if source is None else (source,)
    root = [_stored(spark, sf_dir, name, s) for s in sources][0]
    st = W.schemas.WAREHOUSE[name]
    df = spark.read.schema(st).option("basePath", W.table_path(root, name)).parquet(
        *[_source_path(root, name, s) for s in sources]).select(*st.fieldNames())
    # a constant behind the partition filter: joins and groups by the source don't move it
    return df if source is None else df.where(F.col("source") == F.lit(source)).withColumn("source", F.lit(source))


def release(spark: SparkSession) -> list[str]:
    """Remove the landing/warehouse twins this application built.

    They are scoped to the application, so nothing another job reads is
    touched. Returns the folders removed.
    """
    app = spark.sparkContext.applicationId
    removed = []
    with _LOCK:
        for key in [k for k in _FP if k[1] == app]:
            for fp in _FP.pop(key):
                path = os.path.join(checkpoint_dir(spark), "chartlake-twin", fp)
                fs, p = _fs(spark, path)
                if fs.exists(p):
                    fs.delete(p, True)
                    removed.append(path)
    return removed
