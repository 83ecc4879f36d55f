"""Declared schemas: raw landing collections and warehouse tables.

Raw documents are read with these explicit schemas (no inference), so a new
field in a source response never leaks into the warehouse and a type change
shows up as NULL / ``_corrupt_record`` instead of a silent schema drift.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw landing collections ------------------------------------------------

SPOTIFY_ARTIST_REF = _struct(("id", S), ("href", S))

SPOTIFY_TRACK = _struct(
    ("id", S), ("name", S), ("duration_ms", L), ("popularity", L),
    ("artists", T.ArrayType(SPOTIFY_ARTIST_REF)),
)

SPOTIFY_TOP_TRACKS = _struct(
    ("href", S), ("limit", L), ("next", S), ("offset", L), ("previous", S), ("total", L),
    ("items", T.ArrayType(_struct(("added_at", S), ("track", SPOTIFY_TRACK)))),
    ("data_time", S),
)

SPOTIFY_ARTISTS = _struct(
    ("id", S), ("name", S), ("followers", _struct(("total", L))),
    ("genres", T.ArrayType(S)), ("data_time", S),
)

SOUNDCLOUD_TRACK = _struct(
    ("id", L), ("title", S), ("duration", L), ("release_date", S), ("created_at", S),
    ("likes_count", L), ("user_id", L), ("genre", S),
)

SOUNDCLOUD_TOP_TRACKS = _struct(
    ("genre", S), ("kind", S), ("last_updated", S), ("query_urn", S),
    ("collection", T.ArrayType(_struct(("track", SOUNDCLOUD_TRACK)))),
    ("data_time", S),
)

# Real artist documents and the per-run "missing ids" report share one
# collection; the union schema keeps both shapes (type/data are NULL on
# artist rows).
SOUNDCLOUD_ARTISTS = _struct(
    ("id", L), ("full_name", S), ("followers_count", L),
    ("type", S), ("data", T.ArrayType(L)), ("data_time", S),
)

# Names of the four raw landing collections.
RAW = {
    "spotify_top_tracks": SPOTIFY_TOP_TRACKS,
    "spotify_artists": SPOTIFY_ARTISTS,
    "soundcloud_top_tracks": SOUNDCLOUD_TOP_TRACKS,
    "soundcloud_artists": SOUNDCLOUD_ARTISTS,
}

# ---- warehouse ---------------------------------------------------------------

ARTISTS = _struct(
    ("artist_id", S), ("name", S), ("source", S), ("total_followers", L),
    ("snapshot_time", TS),
)

TRACKS = _struct(
    ("track_id", S), ("name", S), ("duration", L), ("source", S),
    ("release_date", TS), ("popularity", L), ("artist_id", S), ("snapshot_time", TS),
)

TRACK_GENRES = _struct(("track_id", S), ("genre", S), ("source", S), ("snapshot_time", TS))

METADATA = _struct(("record_type", S), ("key", S), ("data_time", TS))

WAREHOUSE = {"artists": ARTISTS, "tracks": TRACKS, "track_genres": TRACK_GENRES}

# Natural keys of the warehouse tables (within one snapshot of one source).
KEYS = {
    "artists": ["artist_id"],
    "tracks": ["track_id", "artist_id"],
    "track_genres": ["track_id", "genre"],
}

# Column widths and limits declared by the reference warehouse.
ID_MAX_LEN = 32
SOURCE_MAX_LEN = 50
NAME_MAX_LEN = 100
GENRE_MAX_LEN = 50
UNSIGNED_INT_MAX = 4294967295
UNKNOWN_ARTIST = "No Artist"
DEFAULT_LIMIT = 50
