"""Registered queries over stored state: loads through the landing and the published
warehouse, its catalogue, row changes, the stream, collated genres, Variant documents.

The landing is the twin's documents stamped anew with two runs a quarter, written
in run folders, so a load has some fifty snapshots at every size. Its tables
are loaded by the production job and read back; ``changed_root`` is a second
warehouse with a year of one source taken out, two upserts and a row delete.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import functions as CF
from chartlake import operators as OP
from chartlake.plans import job, reads, transform
from chartlake.plans import materialize as M
from chartlake.plans import registry as R
from chartlake.sources import landing as L
from chartlake.sources import published as P
from chartlake.sources import warehouse as W
from chartlake.streaming.incremental import ingest

register = R.register

# Fixed values used by the registered queries.
DROPPED_YEAR, DELETED_YEAR = 1995, 1996
GENRE_ASKED = "Prómo"
HOUR_SNAP = "date_trunc('hour', o_orderdate + INTERVAL 30 MINUTE) AS snap"
RUN_SNAP = ("date_trunc('quarter', o_orderdate) + CASE WHEN day(o_orderdate) <= 15 THEN INTERVAL 6 HOUR "
            "ELSE INTERVAL 18 HOUR END AS snap")

SP = R.SP_TRACKS.replace(HOUR_SNAP, RUN_SNAP)
SC = R.SC_FACTS.replace(HOUR_SNAP, RUN_SNAP)
BOTH = R.BOTH.replace(HOUR_SNAP, RUN_SNAP) + """,
tracks AS (SELECT * FROM sp_tracks UNION ALL SELECT * FROM sc_tracks),
artists AS (SELECT * FROM sp_artists UNION ALL SELECT * FROM sc_artists),
genres AS (SELECT * FROM sp_genres UNION ALL SELECT * FROM sc_genres)"""


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """A folder of this application's twin, built when it isn't there yet."""
    root = os.path.join(M._root(spark, sf_dir), name)
    with M._LOCK:
        if not M._done(spark, root, "_COMPLETE"):
            build(root)
            M._mark(spark, root)
    return root


def _restamped(docs: DataFrame) -> DataFrame:
    """Documents with the run of their quarter: at 6 those of a month's first half, at 18 the others."""
    at = F.to_date(F.substring("data_time", 1, 10))
    half = F.when(F.dayofmonth(at) <= 15, "06").otherwise("18")
    run = F.concat(F.date_format(F.trunc(at, "quarter"), "yyyy-MM-dd"), F.lit("T"), half, F.lit(":00:00+00:00"))
    return docs.withColumn("data_time", run).hint("rebalance", "data_time")


def _land(spark: SparkSession, sf_dir: str, root: str, collection: str, part: int | None = None) -> None:
    """Land one collection's documents; with ``part`` one half of them, by document."""
    docs = M.documents(spark, sf_dir, collection)
    if part is not None:
        docs = docs.where(F.pmod(F.xxhash64("href" if "href" in docs.columns else "query_urn"), F.lit(2)) == part)
    L.land(_restamped(docs), root, collection, mode="append")


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    """Run folders of all four collections; the charts landed in two batches."""
    def build(root: str) -> None:
        for collection in M.BUILDERS:
            for part in (0, 1) if "tracks" in collection else (None,):
                _land(spark, sf_dir, root, collection, part)
    return _once(spark, sf_dir, "run-landing", build)


def _snapshots(spark: SparkSession, landing: str, source: str) -> DataFrame:
    stamps = L.run_folders(spark, landing, job.SOURCES[source][0])
    return spark.createDataFrame([(s,) for s in stamps], "data_time string").select(
        transform.snapshot_of("data_time").alias("snapshot_time")).distinct()


def loaded_root(spark: SparkSession, sf_dir: str) -> str:
    """The warehouse after the job has loaded every run of both sources."""
    def build(root: str) -> None:
        landing = landing_root(spark, sf_dir)
        for source in job.SOURCES:
            job.load_snapshots(spark, landing, root, source, _snapshots(spark, landing, source))
    return _once(spark, sf_dir, "loaded-warehouse", build)


def changed_root(spark: SparkSession, sf_dir: str) -> str:
    """The loaded tables after a cascading delete, two upserts of tracks and a delete of genres."""
    def build(root: str) -> None:
        loaded = loaded_root(spark, sf_dir)
        P.publish(spark, root, {t: P.read(spark, loaded, t) for t in W.WRITE_ORDER}, placed=True)
        P.drop(spark, root, (F.col("source") == transform.SPOTIFY) & (F.year("snapshot_time") == DROPPED_YEAR))
        tracks = P.read(spark, root, "tracks")
        P.upsert(spark, root, "tracks", tracks.where("duration % 7000 = 0").withColumn("popularity", F.lit(-1)))
        tracks = P.read(spark, root, "tracks")
        named = tracks.where("popularity >= 45").withColumn("name", F.upper("name"))
        new = tracks.where((F.col("popularity") == 40) & (F.col("source") == transform.SOUNDCLOUD)).withColumn(
            "track_id", F.concat(F.lit("N"), "track_id"))
        P.upsert(spark, root, "tracks", named.unionByName(new))
        keys = ["track_id", "snapshot_time", "source"]
        parents = P.read(spark, root, "tracks").where("popularity < 10").select(*keys)
        P.delete(spark, root, "track_genres", lambda rows: rows.join(parents, keys, "left_semi"),
                 (F.col("source") == transform.SOUNDCLOUD) & (F.year("snapshot_time") == DELETED_YEAR))
    return _once(spark, sf_dir, "changed-warehouse", build)


def streamed_root(spark: SparkSession, sf_dir: str) -> str:
    """The warehouse after two starts of the stream: half of the charts with all artists, then the rest."""
    def build(root: str) -> None:
        landing, state = os.path.join(root, "landing"), os.path.join(root, "state")
        for collection, part in (("spotify_artists", None), ("spotify_top_tracks", 0), ("spotify_top_tracks", 1)):
            _land(spark, sf_dir, landing, collection, part)
            if part is not None:
                ingest(spark, landing, os.path.join(root, "warehouse"), transform.SPOTIFY, state,
                       remember="3650 days").awaitTermination()
    return os.path.join(_once(spark, sf_dir, "streamed", build), "warehouse")


def _followers(df: DataFrame) -> DataFrame:
    # as double: clients differ in how they show a nullable integer
    return df.withColumn("total_followers", F.col("total_followers").cast("double"))


# --- load and read back (W1, W3, W9, W10, W12, W13, S8, S9) ----------------------------

@register("load_tracks", BOTH + "\nSELECT * FROM tracks")
def load_tracks(spark, d):
    return P.read(spark, loaded_root(spark, d), "tracks")


@register("load_artists", BOTH + """
SELECT artist_id, name, source, CAST(total_followers AS DOUBLE) AS total_followers, snapshot_time FROM artists""")
def load_artists(spark, d):
    return _followers(P.read(spark, loaded_root(spark, d), "artists"))


@register("load_genres", BOTH + "\nSELECT * FROM genres")
def load_genres(spark, d):
    return P.read(spark, loaded_root(spark, d), "track_genres")


@register("stream_ingest", "WITH " + SP + "\nSELECT * FROM sp_tracks")
def stream_ingest(spark, d):
    """Tracks of a warehouse that the stream alone has written (2.12)."""
    return P.read(spark, streamed_root(spark, d), "tracks")


# --- the catalogue (W7, W8, A2, J3) ------------------------------------------------------

def _catalogue_sql(table: str, key: str) -> str:
    return (f"SELECT '{table}' AS record_type, source, snapshot_time AS data_time, count(*) AS n_rows, "
            f"min({key}) AS min_key, max({key}) AS max_key FROM {table.replace('track_', '')} GROUP BY ALL")


@register("snapshot_catalogue", BOTH + "\n" + "\nUNION ALL ".join([
    _catalogue_sql("tracks", "concat_ws('|', track_id, artist_id)"), _catalogue_sql("artists", "artist_id"),
    _catalogue_sql("track_genres", "concat_ws('|', track_id, genre)")]))
def snapshot_catalogue(spark, d):
    """What the stored catalogue says of each snapshot of each table: no fact is read."""
    return P.catalogue(spark, loaded_root(spark, d))


@register("latest_by_catalogue", "WITH " + SP + """
SELECT source, artist_id, name, total_followers, snapshot_time AS chart_date FROM sp_artists
WHERE snapshot_time IN (SELECT max(snapshot_time) FROM sp_artists GROUP BY CAST(snapshot_time AS DATE))""")
def latest_by_catalogue(spark, d):
    """Artists of every day's latest snapshot, found in the catalogue."""
    return reads.artists_at(P.read_latest(spark, loaded_root(spark, d), "artists", source=transform.SPOTIFY),
                            all_snapshots=True)


# --- changes (W2, W4-W7, J6) ---------------------------------------------------------------

CHANGED = BOTH + f""",
kept AS (SELECT * FROM tracks WHERE NOT (source = 'spotify' AND year(snapshot_time) = {DROPPED_YEAR})),
once AS (SELECT * REPLACE (CASE WHEN duration % 7000 = 0 THEN -1 ELSE popularity END AS popularity) FROM kept),
changed AS (
  SELECT * REPLACE (CASE WHEN popularity >= 45 THEN upper(name) ELSE name END AS name) FROM once
  UNION ALL
  SELECT * REPLACE ('N' || track_id AS track_id) FROM once WHERE popularity = 40 AND source = 'soundcloud'),
left_genres AS (
  SELECT * FROM genres g WHERE NOT (source = 'spotify' AND year(snapshot_time) = {DROPPED_YEAR})
  AND NOT (source = 'soundcloud' AND year(snapshot_time) = {DELETED_YEAR} AND EXISTS (
    SELECT 1 FROM changed t WHERE t.track_id = g.track_id AND t.snapshot_time = g.snapshot_time
    AND t.source = g.source AND t.popularity < 10)))"""


@register("upsert_published", CHANGED + "\nSELECT * FROM changed")
def upsert_published(spark, d):
    """Tracks after two upserts: new rows beside the old files, replaced rows marked."""
    return P.read(spark, changed_root(spark, d), "tracks")


@register("delete_published", CHANGED + "\nSELECT * FROM left_genres")
def delete_published(spark, d):
    """Genres after the delete by their parents' rows: marked, no file written anew."""
    return P.read(spark, changed_root(spark, d), "track_genres")


@register("cascade_delete", CHANGED + f"""
SELECT 'tracks' AS record_type, source, snapshot_time AS data_time, count(*) AS n_rows FROM changed GROUP BY ALL
UNION ALL
SELECT 'artists', source, snapshot_time, count(*) FROM artists
WHERE NOT (source = 'spotify' AND year(snapshot_time) = {DROPPED_YEAR}) GROUP BY ALL
UNION ALL
SELECT 'track_genres', source, snapshot_time, count(*) FROM left_genres GROUP BY ALL""")
def cascade_delete(spark, d):
    """The catalogue after snapshots went from all tables at once, upserts and row deletes."""
    left = P.catalogue(spark, changed_root(spark, d)).where("n_rows > 0")
    return left.select("record_type", "source", "data_time", F.col("n_rows").cast("bigint").alias("n_rows"))


# --- genres under the collation (A5, F4, J5) -------------------------------------------------

GENRES = """
WITH g AS (SELECT p_partkey AS track_id, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type)
                  WHEN 2 THEN replace(p_type, 'A', 'Á') ELSE replace(lower(p_type), 'e', 'é') END AS genre FROM part)"""
FOLD = "lower(strip_accents(genre))"


def _spelled(spark, d):
    """Each part's type as a genre, in four spellings."""
    n, p = F.col("p_partkey") % 4, F.col("p_type")
    return R._t(spark, d, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.when(n == 0, p).when(n == 1, F.lower(p)).when(n == 2, F.replace(p, F.lit("A"), F.lit("Á")))
        .otherwise(F.replace(F.lower(p), F.lit("e"), F.lit("é"))).alias("genre"))


@register("distinct_genres_folded", GENRES + f"\nSELECT min(genre) AS genre FROM g GROUP BY {FOLD}")
def distinct_genres_folded(spark, d):
    return OP.folded_genres(_spelled(spark, d))


@register("genre_filter_folded", GENRES + f"""
SELECT track_id, genre FROM g WHERE {FOLD} = lower(strip_accents('{GENRE_ASKED}'))""")
def genre_filter_folded(spark, d):
    return _spelled(spark, d).where(OP.same_genre("genre", F.lit(GENRE_ASKED)))


@register("genre_join_folded", GENRES + f""",
f AS (SELECT min(genre) AS genre, {FOLD} AS fold FROM g GROUP BY {FOLD})
SELECT g.track_id, f.genre FROM g JOIN f ON f.fold = lower(strip_accents(g.genre))""")
def genre_join_folded(spark, d):
    """Every track's genre in the one spelling kept of it: a join on the collated key."""
    spelled = _spelled(spark, d)
    return OP.with_folded_genre(spelled, OP.folded_genres(spelled))


@register("genres_of_artist_folded", GENRES + f"""
SELECT l_suppkey AS artist_id, min(genre) AS genre FROM lineitem JOIN g ON track_id = l_partkey
GROUP BY l_suppkey, {FOLD}""")
def genres_of_artist_folded(spark, d):
    tracks = R._t(spark, d, "lineitem").select(F.col("l_partkey").alias("track_id"), F.col("l_suppkey").alias("artist_id"))
    return OP.folded_genres_of(_spelled(spark, d), tracks, by="artist_id", along=[])


# --- JSON paths without a schema (X5) -----------------------------------------------------------

def _variants(spark, d):
    """Landed documents as JSON text with a key that the declared schema lacks, parsed as Variant."""
    docs = R.sp_docs(spark, d)
    extra = F.struct(F.transform("items.track.id", lambda t: F.struct(F.upper(t).alias("tag"))).alias("tags"))
    text = F.to_json(F.struct(*docs.columns, extra.alias("undeclared")))
    return docs.select("href", CF.parse_variant(text).alias("doc"))


def _variant_rows(spark, d, path):
    value = CF.variant_path("doc", path)
    many = "*" in path or ":" in path
    return _variants(spark, d).select("href", (F.array_join(value, ",") if many else value).alias("value"))


@register("variant_index", R.ORACLE["json_path_index"])
def variant_index(spark, d):
    return _variant_rows(spark, d, "items.[0].track.id")


@register("variant_wildcard", R.ORACLE["json_path_wildcard"])
def variant_wildcard(spark, d):
    return _variant_rows(spark, d, "items.[*].track.id")


@register("variant_slice", R.ORACLE["json_path_slice"])
def variant_slice(spark, d):
    return _variant_rows(spark, d, "items.[1:3].track.id")


@register("variant_undeclared", R.ORACLE["json_path_wildcard"].replace("r.track_id", "upper(r.track_id)"))
def variant_undeclared(spark, d):
    return _variant_rows(spark, d, "undeclared.tags.[*].tag")


@register("variant_nested_wildcard", R.ORACLE["json_path_nested_wildcard"])
def variant_nested_wildcard(spark, d):
    lol = CF.variant_path("doc", "items.[*].track.artists.[*].id")
    return _variants(spark, d).select(
        "href", F.array_join(F.transform(lol, lambda a: F.array_join(a, "+")), ",").alias("value"))


@register("variant_props", R.ORACLE["json_path_props"])
def variant_props(spark, d):
    return R._t(spark, d, "events").select(
        "event_id", CF.variant_path(CF.parse_variant("props"), "k", "bigint").alias("k"))
