"""Raw chart documents -> warehouse facts (tracks, artists, track_genres).

Each transform works on any number of runs at once: the snapshot of a row
is the hour-rounded run stamp of its document (or a fixed ``snapshot_time``
passed for a single run), and every key includes it. All steps are built-in
expressions; explodes stay in the scan stage; the only shuffles are the
deduplications and the genre join. ``dedupe`` (rows, keys, order) is how a
transform folds repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.functions.text import unknown_member
from chartlake.functions.time import coalesce_timestamp, parse_iso, round_to_hour
from chartlake.operators.dedupe import dedupe_latest
from chartlake.operators.nested import explode_fields
from chartlake.operators.genres import genre_bridge
from chartlake.schemas import UNKNOWN_ARTIST

# The source tags the warehouse stores for the two chart sources.
SPOTIFY, SOUNDCLOUD = "spotify", "soundcloud"
# Fixed value: the type of a missing-ids report among the artist documents.
MISSING = "missing_artists"

TRACK_COLS = ["track_id", "name", "duration", "source", "release_date", "popularity",
              "artist_id", "snapshot_time"]
ARTIST_COLS = ["artist_id", "name", "source", "total_followers", "snapshot_time"]
GENRE_COLS = ["track_id", "genre", "source", "snapshot_time"]

# survivor order for duplicates of one key inside one snapshot
def track_order():
    return [F.col("release_date").desc_nulls_last(), F.col("popularity").desc_nulls_last(),
            F.col("name").asc_nulls_last(), F.col("duration").asc_nulls_last()]


def artist_order():
    return [F.col("total_followers").desc_nulls_last(), F.col("name").asc_nulls_last()]


def snapshot_of(data_time, snapshot_time=None):
    """Snapshot column: the given run time, or the run stamp of each document."""
    src = F.lit(str(snapshot_time)) if snapshot_time is not None else F.col(data_time)
    return round_to_hour(parse_iso(src))


def spotify_tracks(raw: DataFrame, snapshot_time=None, dedupe=dedupe_latest) -> DataFrame:
    docs = raw.select(snapshot_of("data_time", snapshot_time).alias("snapshot_time"), "items")
    items = explode_fields(docs, "items", {
        "track_id": "track.id", "name": "track.name", "duration": "track.duration_ms",
        "popularity": "track.popularity", "added_at": "added_at",
        "artist_ids": F.transform("items.track.artists", lambda a: a["id"])}, keep=["snapshot_time"])
    # second level: one row per artist; a track without artists vanishes
    tracks = items.select(
        "track_id", "name", "duration", F.lit(SPOTIFY).alias("source"),
        parse_iso("added_at").alias("release_date"), "popularity",
        F.explode("artist_ids").alias("artist_id"), "snapshot_time")
    return dedupe(tracks, ["snapshot_time", "track_id", "artist_id"], track_order())


def spotify_artists(raw: DataFrame, snapshot_time=None, dedupe=dedupe_latest) -> DataFrame:
    arts = raw.select(
        F.col("id").alias("artist_id"), "name", F.lit(SPOTIFY).alias("source"),
        F.col("followers.total").alias("total_followers"),
        snapshot_of("data_time", snapshot_time).alias("snapshot_time"))
    return dedupe(arts, ["snapshot_time", "artist_id"], artist_order())


def spotify_genres(tracks: DataFrame, raw_artists: DataFrame, snapshot_time=None,
                   tracks_unique: bool = True, dedupe=dedupe_latest) -> DataFrame:
    """``tracks`` is the transform's (or the warehouse's) tracks table, unique
    on (snapshot_time, track_id, artist_id) by its key; pass
    ``tracks_unique=False`` for any other input."""
    arts = raw_artists.select("id", "genres",
                              snapshot_of("data_time", snapshot_time).alias("snapshot_time"))
    g = genre_bridge(tracks, arts, along=["snapshot_time"], pairs_unique=tracks_unique, dedupe=dedupe)
    return g.select("track_id", "genre", F.lit(SPOTIFY).alias("source"), "snapshot_time")


def spotify(raw_tracks: DataFrame, raw_artists: DataFrame, snapshot_time=None):
    """-> (tracks, artists, track_genres)."""
    tracks = spotify_tracks(raw_tracks, snapshot_time)
    artists = spotify_artists(raw_artists, snapshot_time)
    genres = spotify_genres(tracks, raw_artists, snapshot_time)
    return tracks, artists, genres


def soundcloud_tracks(raw: DataFrame, snapshot_time=None, dedupe=dedupe_latest) -> DataFrame:
    docs = raw.select(snapshot_of("data_time", snapshot_time).alias("snapshot_time"), "collection")
    items = explode_fields(docs, "collection", {
        "id": "track.id", "title": "track.title", "duration": "track.duration",
        "release_text": "track.release_date", "created_text": "track.created_at",
        "likes": "track.likes_count", "user_id": "track.user_id"}, keep=["snapshot_time"])
    tracks = items.select(
        F.col("id").cast("string").alias("track_id"),
        F.col("title").alias("name"),
        "duration",
        F.lit(SOUNDCLOUD).alias("source"),
        coalesce_timestamp("release_text", "created_text").alias("release_date"),
        F.col("likes").alias("popularity"),
        unknown_member("user_id").alias("artist_id"),
        "snapshot_time")
    return dedupe(tracks, ["snapshot_time", "track_id", "artist_id"], track_order())


def soundcloud_genres(raw: DataFrame, snapshot_time=None) -> DataFrame:
    """Genre is a field of the track itself; blank genres are dropped
    (the column is NOT NULL) and repeats collapse."""
    docs = raw.select(snapshot_of("data_time", snapshot_time).alias("snapshot_time"), "collection")
    items = explode_fields(docs, "collection", {"id": "track.id", "genre": "track.genre"},
                           keep=["snapshot_time"])
    g = items.select(F.col("id").cast("string").alias("track_id"), "genre",
                     F.lit(SOUNDCLOUD).alias("source"), "snapshot_time")
    return g.where(F.col("genre").isNotNull() & (F.trim("genre") != "")).distinct()


def soundcloud_artists(raw: DataFrame, raw_tracks: DataFrame | None = None,
                       snapshot_time=None, dedupe=dedupe_latest) -> DataFrame:
    """Artist documents only (the per-run missing-ids sentinel is split off).

    When ``raw_tracks`` is given, the unknown member is added for every
    snapshot whose charts hold a track without a user, so the tracks ->
    artists key holds. That check reads the raw documents (an explode and a
    distinct over snapshots), not the deduplicated tracks.
    """
    docs = raw.where(~F.col("type").eqNullSafe(F.lit(MISSING)))
    arts = docs.select(
        unknown_member("id").alias("artist_id"), F.col("full_name").alias("name"),
        F.lit(SOUNDCLOUD).alias("source"), F.col("followers_count").alias("total_followers"),
        snapshot_of("data_time", snapshot_time).alias("snapshot_time"))
    arts = dedupe(arts, ["snapshot_time", "artist_id"], artist_order())
    if raw_tracks is not None:
        users = raw_tracks.select(snapshot_of("data_time", snapshot_time).alias("snapshot_time"),
                                  F.explode("collection.track.user_id").alias("user_id"))
        unknown = (users.where(F.col("user_id").isNull()).select("snapshot_time").distinct()
                   .select(F.lit(UNKNOWN_ARTIST).alias("artist_id"),
                           F.lit(None).cast("string").alias("name"),
                           F.lit(SOUNDCLOUD).alias("source"),
                           F.lit(None).cast("bigint").alias("total_followers"), "snapshot_time"))
        arts = arts.unionByName(unknown.join(arts, ["snapshot_time", "artist_id"], "left_anti")
                                .select(*ARTIST_COLS))
    return arts.select(*ARTIST_COLS)


def soundcloud_missing(raw: DataFrame) -> DataFrame:
    """Ids reported missing by the fetch step: ``(id, data_time)`` rows."""
    return (raw.where(F.col("type") == MISSING)
               .select(F.explode("data").alias("id"), "data_time"))


def soundcloud(raw_tracks: DataFrame, raw_artists: DataFrame, snapshot_time=None):
    """-> (tracks, artists, track_genres)."""
    tracks = soundcloud_tracks(raw_tracks, snapshot_time)
    artists = soundcloud_artists(raw_artists, raw_tracks, snapshot_time)
    genres = soundcloud_genres(raw_tracks, snapshot_time)
    return tracks, artists, genres


def spotify_load(raw_tracks: DataFrame, raw_artists: DataFrame) -> dict:
    """The tables of a load; the genres are made of the tracks as written, not of another run of them."""
    return {"artists": spotify_artists(raw_artists), "tracks": spotify_tracks(raw_tracks),
            "track_genres": lambda written: spotify_genres(written["tracks"], raw_artists)}


def soundcloud_load(raw_tracks: DataFrame, raw_artists: DataFrame) -> dict:
    tracks, artists, genres = soundcloud(raw_tracks, raw_artists)
    return {"artists": artists, "tracks": tracks, "track_genres": genres}
