"""Registered queries: each operator of the inventory run over the whole
driver tables, with an independent SQL formulation for the oracle check.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is plain
SQL over the raw tables (DuckDB dialect), sharing the CTEs below that
restate the twin documents and the transforms relationally (flat joins
instead of nested documents).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import functions as CF
from chartlake import operators as OP
from chartlake import schemas
from chartlake.plans import materialize as M
from chartlake.plans import reads, transform, twin
from chartlake.sources import landing as L

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

# Fixed values used by the registered queries (parameters of the operators).
URL_TEMPLATE = "https://api.example.com/users/%s"
URL_PARAMS = {"src": "chartlake", "v": "2"}
MARKER, MARKER_WIDTH = "<title>", 32
LINK_PATTERN = 'href="([^"]+)"'
DELETE_AT, DELETE_SOURCE = "2024-01-15 00:00:00", "view"
CHILD_DELETE_DAY, PARENT_SOURCE = "1996-01-10", "F"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Shared Spark building blocks
# ---------------------------------------------------------------------------

def _t(spark, d, name):
    return twin.table(spark, d, name)


def sp_docs(spark, d):
    """Landed Spotify chart documents (nested parquet, declared schema)."""
    return M.raw(spark, d, "spotify_top_tracks", alone=True)


def sc_docs(spark, d):
    return M.raw(spark, d, "soundcloud_top_tracks", alone=True)


def sp_facts(spark, d):
    """The Spotify transform run on the landed documents."""
    # the artists are made of the pages, so the charts are too
    return transform.spotify(M.raw(spark, d, "spotify_top_tracks"), M.raw(spark, d, "spotify_artists"))


def sc_facts(spark, d):
    return transform.soundcloud(sc_docs(spark, d), M.raw(spark, d, "soundcloud_artists"))


def wh(spark, d, source, *tables):
    """Warehouse tables of one source, by name."""
    return tuple(M.table(spark, d, t, source) for t in tables)


def events_snap(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", "user_id", F.col("event_type").alias("source"),
                    CF.round_to_hour("ts").alias("snapshot_time"))


def json_docs(spark, d):
    """Documents as they land (JSON text), re-read with the declared schema."""
    docs = sp_docs(spark, d)
    text = docs.select("href", F.to_json(F.struct(*docs.columns)).alias("doc"))
    return text.select("href", F.from_json("doc", schemas.SPOTIFY_TOP_TRACKS).alias("doc"))


# ---------------------------------------------------------------------------
# Shared SQL: the twin documents and transforms, stated relationally
# ---------------------------------------------------------------------------

LINES = f"""
lines AS (
  SELECT *, date_trunc('hour', o_orderdate + INTERVAL 30 MINUTE) AS snap,
         CASE WHEN l_partkey % 19 = 0 THEN CAST(l_partkey AS VARCHAR) || repeat('0', 32)
              ELSE CAST(l_partkey AS VARCHAR) END AS t_id,
         CASE WHEN l_partkey % 13 = 0 THEN p_name || repeat('x', 101) ELSE p_name END AS t_name,
         CAST(p_size AS BIGINT) * CASE WHEN l_partkey % 17 = 0 THEN -1000 ELSE 1000 END AS t_duration,
         CASE WHEN l_quantity = 50 THEN -50 ELSE CAST(l_quantity AS BIGINT) END AS t_popularity,
         CASE l_partkey % 11 WHEN 0 THEN ' ' WHEN 1 THEN NULL WHEN 2 THEN p_type || repeat('x', 60)
              ELSE p_type END AS t_genre,
         CASE WHEN l_linenumber <> {twin.NO_USER_LINE} THEN l_suppkey END AS user_id,
         CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN NULL
              WHEN l_returnflag <> 'N' THEN l_shipdate ELSE o_orderdate END AS sc_release
  FROM (
    SELECT o.o_orderkey, o.o_custkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
           l.l_shipdate, l.l_returnflag, p.p_name, p.p_size, p.p_type,
           o.o_orderdate + to_minutes((o.o_orderkey % 48) * 30) AS o_orderdate
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON p.p_partkey = l.l_partkey) x)"""

RANKED = LINES + f""",
placed AS (
  SELECT *, t_id AS track_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS added_at,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate, t_id, t_name, t_duration,
                            t_popularity, concat('s', l_suppkey)) - 1 AS nth
  FROM lines),
ranked AS (SELECT *, nth // {twin.CHART_PAGE} AS page, nth % {twin.CHART_PAGE} AS pos FROM placed),
docs AS (
  SELECT o.o_orderkey, coalesce(r.page, 0) AS page
  FROM orders o LEFT JOIN (SELECT DISTINCT o_orderkey, page FROM ranked) r ON r.o_orderkey = o.o_orderkey)"""

SP_TRACKS = LINES + """,
sp_tracks AS (
  SELECT * FROM (
    SELECT t_id AS track_id, t_name AS name, t_duration AS duration, 'spotify' AS source,
           l_shipdate AS release_date, t_popularity AS popularity,
           concat('s', l_suppkey) AS artist_id, snap AS snapshot_time FROM lines
    UNION ALL
    SELECT t_id, t_name, t_duration, 'spotify', l_shipdate, t_popularity, concat('c', o_custkey),
           snap FROM lines) u
  QUALIFY row_number() OVER (PARTITION BY snapshot_time, track_id, artist_id
            ORDER BY release_date DESC NULLS LAST, popularity DESC NULLS LAST,
                     name ASC NULLS LAST, duration ASC NULLS LAST) = 1),
sp_artists AS (
  SELECT concat('s', s_suppkey) AS artist_id, s_name AS name, 'spotify' AS source,
         CASE WHEN s_suppkey % 31 = 0 THEN 5000000000 ELSE CAST(floor(s_acctbal) AS BIGINT) END
           AS total_followers, r.snap AS snapshot_time
  FROM (SELECT DISTINCT snap, l_suppkey FROM lines) r JOIN supplier ON s_suppkey = r.l_suppkey
  UNION ALL
  SELECT concat('c', c_custkey), CASE WHEN c_custkey % 29 = 0 THEN c_name || repeat('x', 101) ELSE c_name END,
         'spotify', CAST(floor(c_acctbal) AS BIGINT), r.snap
  FROM (SELECT DISTINCT snap, o_custkey FROM lines) r JOIN customer ON c_custkey = r.o_custkey),
artist_nation AS (
  SELECT concat('s', s_suppkey) AS artist_id, s_nationkey AS nk FROM supplier
  UNION ALL SELECT concat('c', c_custkey), c_nationkey FROM customer),
sp_genres AS (
  SELECT DISTINCT track_id, genre, 'spotify' AS source, snapshot_time FROM (
    SELECT t.track_id, t.snapshot_time, unnest([n.n_name, r.r_name]) AS genre
    FROM sp_tracks t
    JOIN sp_artists a ON a.artist_id = t.artist_id AND a.snapshot_time = t.snapshot_time
    JOIN artist_nation an ON an.artist_id = t.artist_id
    JOIN nation n ON n.n_nationkey = an.nk JOIN region r ON r.r_regionkey = n.n_regionkey) x
  WHERE genre IS NOT NULL)"""

SC_FACTS = LINES + """,
sc_tracks AS (
  SELECT CAST(l_partkey AS VARCHAR) AS track_id, t_name AS name, t_duration AS duration,
         'soundcloud' AS source, sc_release AS release_date, t_popularity AS popularity,
         coalesce(CAST(user_id AS VARCHAR), 'No Artist') AS artist_id, snap AS snapshot_time
  FROM lines
  QUALIFY row_number() OVER (PARTITION BY snapshot_time, track_id, artist_id
            ORDER BY release_date DESC NULLS LAST, popularity DESC NULLS LAST,
                     name ASC NULLS LAST, duration ASC NULLS LAST) = 1),
sc_artists AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS name, 'soundcloud' AS source,
         CAST(floor(s_acctbal) AS BIGINT) AS total_followers, r.snap AS snapshot_time
  FROM (SELECT DISTINCT snap, user_id FROM lines) r JOIN supplier ON s_suppkey = r.user_id
  WHERE s_acctbal >= 0
  UNION ALL
  SELECT DISTINCT 'No Artist', CAST(NULL AS VARCHAR), 'soundcloud', CAST(NULL AS BIGINT), snap
  FROM lines WHERE user_id IS NULL),
sc_genres AS (
  SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS track_id, t_genre AS genre, 'soundcloud' AS source,
         snap AS snapshot_time
  FROM lines WHERE t_genre IS NOT NULL AND trim(t_genre) <> '')"""

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type AS source,
         date_trunc('hour', ts + INTERVAL 30 MINUTE) AS snapshot_time FROM events)"""

RUN_STAMP = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------------------
# Generators / projections
# ---------------------------------------------------------------------------

@register("explode_items", _with(RANKED) + """
SELECT concat('/charts/', o_orderkey, '/', page) AS href, CAST(pos AS BIGINT) AS position,
       track_id, added_at
FROM ranked""")
def explode_items(spark, d):
    items = OP.explode_fields(sp_docs(spark, d), "items",
                              {"track_id": "track.id", "added_at": "added_at"},
                              keep=["href"], position="position")
    return items.select("href", F.col("position").cast("bigint").alias("position"),
                        "track_id", "added_at")


@register("explode_two_level", _with(RANKED) + """
SELECT concat('/charts/', o_orderkey, '/', page) AS href, track_id,
       concat('s', l_suppkey) AS artist_id FROM ranked
UNION ALL
SELECT concat('/charts/', o_orderkey, '/', page), track_id, concat('c', o_custkey) FROM ranked""")
def explode_two_level(spark, d):
    items = OP.explode_fields(sp_docs(spark, d), "items",
                              {"track_id": "track.id",
                               "artist_ids": F.transform("items.track.artists", lambda a: a["id"])},
                              keep=["href"])
    return items.select("href", "track_id", F.explode("artist_ids").alias("artist_id"))


@register("nested_projection", _with(RANKED) + """
SELECT concat('/charts/', o_orderkey, '/', page) AS href, track_id, t_name AS name,
       t_duration AS duration, t_popularity AS popularity, 'spotify' AS source
FROM ranked""")
def nested_projection(spark, d):
    items = OP.explode_fields(sp_docs(spark, d), "items", {
        "track_id": "track.id", "name": "track.name", "duration": "track.duration_ms",
        "popularity": "track.popularity"}, keep=["href"])
    return items.select("href", "track_id", "name", "duration", "popularity",
                        F.lit("spotify").alias("source"))


@register("coalesce_timestamp", _with(RANKED) + """
SELECT concat('charts:', o_orderkey, ':', page) AS query_urn, CAST(l_partkey AS VARCHAR) AS track_id,
       sc_release AS release_date
FROM ranked""")
def coalesce_timestamp(spark, d):
    items = OP.explode_fields(sc_docs(spark, d), "collection", {
        "id": "track.id", "release_text": "track.release_date", "created_text": "track.created_at"},
        keep=["query_urn"])
    return items.select(
        "query_urn", F.col("id").cast("string").alias("track_id"),
        CF.coalesce_timestamp("release_text", "created_text").alias("release_date"))


@register("unknown_member", """
SELECT o.o_orderkey, coalesce(CAST(l.l_suppkey AS VARCHAR), 'No Artist') AS artist_id
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def unknown_member(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey")
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    return twin.with_items(o, li).select("o_orderkey", CF.unknown_member("l_suppkey").alias("artist_id"))


# ---------------------------------------------------------------------------
# Transforms: dedupe (A3, A4), genre bridge (J1, G4), SoundCloud, union
# ---------------------------------------------------------------------------

@register("dedupe_tracks", _with(SP_TRACKS) + "\nSELECT * FROM sp_tracks")
def dedupe_tracks(spark, d):
    return sp_facts(spark, d)[0]


@register("dedupe_artists", _with(SP_TRACKS) + """
SELECT * FROM sp_artists
QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY snapshot_time DESC) = 1""")
def dedupe_artists(spark, d):
    arts = sp_facts(spark, d)[1]
    return OP.dedupe_latest(arts, ["artist_id"], [F.col("snapshot_time").desc()])


@register("genre_bridge", _with(SP_TRACKS) + "\nSELECT * FROM sp_genres")
def genre_bridge(spark, d):
    return sp_facts(spark, d)[2]


@register("soundcloud_tracks", _with(SC_FACTS) + "\nSELECT * FROM sc_tracks")
def soundcloud_tracks(spark, d):
    return sc_facts(spark, d)[0]


@register("soundcloud_artists", _with(SC_FACTS) + """
SELECT artist_id, name, source, CAST(total_followers AS DOUBLE) AS total_followers, snapshot_time
FROM sc_artists""")
def soundcloud_artists(spark, d):
    # as double: clients differ in how they show a nullable integer
    return sc_facts(spark, d)[1].withColumn("total_followers", F.col("total_followers").cast("double"))


@register("soundcloud_genres", _with(SC_FACTS) + "\nSELECT * FROM sc_genres")
def soundcloud_genres(spark, d):
    return sc_facts(spark, d)[2]


@register("union_sources", "WITH " + SP_TRACKS.strip() + "," + SC_FACTS.replace(LINES + ",", "") + """
SELECT * FROM sp_tracks UNION ALL SELECT * FROM sc_tracks""")
def union_sources(spark, d):
    return sp_facts(spark, d)[0].unionByName(sc_facts(spark, d)[0])


# ---------------------------------------------------------------------------
# Snapshot time
# ---------------------------------------------------------------------------

@register("round_to_hour", """
SELECT date_trunc('hour', ts + INTERVAL 30 MINUTE) AS snapshot_time, event_type,
       count(*) AS n
FROM events GROUP BY 1, 2""")
def round_to_hour(spark, d):
    e = _t(spark, d, "events")
    return e.groupBy(CF.round_to_hour("ts").alias("snapshot_time"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))


@register("latest_snapshot_of_day", _with(EVENTS) + """
SELECT event_id, source, snapshot_time FROM ev
WHERE snapshot_time IN (SELECT max(snapshot_time) FROM ev GROUP BY CAST(snapshot_time AS DATE))""")
def latest_snapshot_of_day(spark, d):
    return OP.latest_of_day(events_snap(spark, d)).select("event_id", "source", "snapshot_time")


def _metadata(spark, d):
    tr, ar, ge = wh(spark, d, transform.SPOTIFY, "tracks", "artists", "track_genres")
    return OP.snapshot_metadata({
        "tracks": (tr, schemas.KEYS["tracks"]),
        "artists": (ar, schemas.KEYS["artists"]),
        "track_genres": (ge, schemas.KEYS["track_genres"]),
    }), tr


@register("snapshot_metadata", _with(SP_TRACKS) + """
SELECT 'tracks' AS record_type, concat_ws('|', track_id, artist_id) AS key, snapshot_time AS data_time
FROM sp_tracks
UNION ALL SELECT 'artists', artist_id, snapshot_time FROM sp_artists
UNION ALL SELECT 'track_genres', concat_ws('|', track_id, genre), snapshot_time FROM sp_genres""")
def snapshot_metadata(spark, d):
    return _metadata(spark, d)[0]


@register("snapshot_join", _with(SP_TRACKS) + """,
md AS (SELECT concat_ws('|', track_id, artist_id) AS key, snapshot_time AS data_time FROM sp_tracks),
latest AS (SELECT max(data_time) AS m FROM md GROUP BY CAST(data_time AS DATE))
SELECT t.track_id, t.artist_id, md.data_time AS chart_date
FROM sp_tracks t JOIN md ON md.key = concat_ws('|', t.track_id, t.artist_id)
                         AND md.data_time = t.snapshot_time
WHERE md.data_time IN (SELECT m FROM latest)""")
def snapshot_join(spark, d):
    """Tracks joined to the metadata view on the record's key, at each day's latest time.

    Both sides are cut to those times, one a day and so broadcast, before the join moves them."""
    md, tr = _metadata(spark, d)
    times = md.where(F.col("record_type") == "tracks").select("key", "data_time")
    latest = F.broadcast(times.groupBy(F.to_date("data_time")).agg(F.max("data_time").alias("m")).select("m"))
    times = times.join(latest, F.col("data_time") == F.col("m"), "left_semi")
    tr = tr.join(latest, F.col("snapshot_time") == F.col("m"), "left_semi")
    out = tr.join(times, (F.concat_ws("|", "track_id", "artist_id") == F.col("key"))
                  & (F.col("snapshot_time") == F.col("data_time")))
    return out.select("track_id", "artist_id", F.col("data_time").alias("chart_date"))


# ---------------------------------------------------------------------------
# Read queries
# ---------------------------------------------------------------------------

GROUPED = """
SELECT source, duration, popularity, track_id,
       nullif(array_to_string(list_sort(list_distinct(list(artist_id))), ','), '') AS artist_id,
       name, release_date, snapshot_time AS chart_date
FROM sp_tracks
GROUP BY source, duration, popularity, track_id, name, release_date, snapshot_time"""


@register("tracks_at_snapshot", _with(SP_TRACKS) + GROUPED)
def tracks_at_snapshot(spark, d):
    return reads.tracks_at(M.table(spark, d, "tracks", transform.SPOTIFY), all_snapshots=True, limit=None, as_string=True)


@register("limit_topk", _with(SP_TRACKS) + ", g AS (" + GROUPED + """)
SELECT * FROM g
ORDER BY chart_date, source, track_id, name, duration, popularity, release_date LIMIT 50""")
def limit_topk(spark, d):
    return reads.tracks_at(M.table(spark, d, "tracks", transform.SPOTIFY), all_snapshots=True, limit=50, as_string=True)


@register("group_concat", _with(SP_TRACKS) + """
SELECT track_id, snapshot_time,
       nullif(array_to_string(list_sort(list_distinct(list(artist_id))), ','), '') AS artists
FROM sp_tracks GROUP BY track_id, snapshot_time""")
def group_concat(spark, d):
    """Artists of each track in each snapshot: a cell holds one chart's artists of a track."""
    tr = M.table(spark, d, "tracks", transform.SPOTIFY)
    return tr.groupBy("track_id", "snapshot_time").agg(CF.group_concat("artist_id").alias("artists"))


@register("split_list", _with(SP_TRACKS) + """,
g AS (SELECT track_id, snapshot_time,
             nullif(array_to_string(list_sort(list_distinct(list(artist_id))), ','), '') AS artists
      FROM sp_tracks GROUP BY track_id, snapshot_time)
SELECT track_id, snapshot_time, CAST(len(string_split(artists, ',')) AS BIGINT) AS n_artists,
       string_split(artists, ',')[1] AS first_artist
FROM g""")
def split_list(spark, d):
    g = group_concat(spark, d)
    arr = CF.split_list("artists")
    return g.select("track_id", "snapshot_time", F.size(arr).cast("bigint").alias("n_artists"),
                    F.get(arr, 0).alias("first_artist"))


@register("artists_of_track", _with(SP_TRACKS) + """
SELECT t.track_id, a.source, a.artist_id, a.name, a.total_followers, a.snapshot_time AS chart_date
FROM (SELECT DISTINCT track_id, artist_id, snapshot_time, source FROM sp_tracks) t
JOIN sp_artists a ON a.artist_id = t.artist_id AND a.snapshot_time = t.snapshot_time
                  AND a.source = t.source""")
def artists_of_track(spark, d):
    tr, ar = wh(spark, d, transform.SPOTIFY, "tracks", "artists")
    return reads.artists_of_tracks(tr, ar, pairs_unique=True)


@register("artists_at_latest", _with(SP_TRACKS) + """
SELECT source, artist_id, name, total_followers, snapshot_time AS chart_date FROM sp_artists
WHERE snapshot_time IN (SELECT max(snapshot_time) FROM sp_artists GROUP BY CAST(snapshot_time AS DATE))""")
def artists_at_latest(spark, d):
    """Artists of the latest snapshot of every day (J3, A2 per table)."""
    (ar,) = wh(spark, d, transform.SPOTIFY, "artists")
    return reads.artists_at(ar, every_day=True, limit=None)


@register("genres_of_track", _with(SP_TRACKS) + """
SELECT DISTINCT g.track_id, g.genre FROM sp_genres g
JOIN sp_tracks t ON t.track_id = g.track_id AND t.snapshot_time = g.snapshot_time
                 AND t.source = g.source""")
def genres_of_track(spark, d):
    tr, ge = wh(spark, d, transform.SPOTIFY, "tracks", "track_genres")
    return OP.genres_of(ge, tr, by="track_id")


@register("genres_of_artist", _with(SP_TRACKS) + """
SELECT DISTINCT t.artist_id, g.genre FROM sp_genres g
JOIN sp_tracks t ON t.track_id = g.track_id AND t.snapshot_time = g.snapshot_time
                 AND t.source = g.source""")
def genres_of_artist(spark, d):
    tr, ge = wh(spark, d, transform.SPOTIFY, "tracks", "track_genres")
    return OP.genres_of(ge, tr, by="artist_id")


@register("genres_of_track_and_artist", _with(SP_TRACKS) + """
SELECT DISTINCT t.track_id, t.artist_id, g.genre FROM sp_genres g
JOIN sp_tracks t ON t.track_id = g.track_id AND t.snapshot_time = g.snapshot_time
                 AND t.source = g.source""")
def genres_of_track_and_artist(spark, d):
    """Both ids given (F4), for every pair of ids at once."""
    tr, ge = wh(spark, d, transform.SPOTIFY, "tracks", "track_genres")
    keys = ["track_id", "snapshot_time", "source"]
    pairs = tr.where(F.col("artist_id").isNotNull()).select(*keys, "artist_id")
    return ge.select(*keys, "genre").join(pairs, keys).select("track_id", "artist_id", "genre").distinct()


@register("genres_list_by_artist", _with(SP_TRACKS) + """
SELECT artist_id, array_to_string(list_sort(list_distinct(list(genre))), ',') AS genres FROM (
  SELECT DISTINCT t.artist_id, g.genre FROM sp_genres g
  JOIN sp_tracks t ON t.track_id = g.track_id AND t.snapshot_time = g.snapshot_time
                   AND t.source = g.source) x
GROUP BY artist_id""")
def genres_list_by_artist(spark, d):
    tr, ge = wh(spark, d, transform.SPOTIFY, "tracks", "track_genres")
    # collect_set folds repeats, so the pairs need no distinct of their own
    return OP.genres_list(OP.genres_of(ge, tr, by="artist_id", distinct=False), "artist_id", sep=",")


@register("distinct_genres", _with(SP_TRACKS) + "\nSELECT DISTINCT genre FROM sp_genres")
def distinct_genres(spark, d):
    return reads.genres(M.table(spark, d, "track_genres", transform.SPOTIFY), limit=None)


@register("optional_filters", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus = 'F'""")
def optional_filters(spark, d):
    li = _t(spark, d, "lineitem")
    # two predicates given, one absent (None) and one empty string (= absent)
    out = OP.optional_filters(li, l_returnflag="R", l_linestatus="F", l_partkey=None, l_suppkey="")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---------------------------------------------------------------------------
# Warehouse DML as DataFrame rewrites
# ---------------------------------------------------------------------------

@register("delete_snapshot", _with(EVENTS) + f"""
SELECT * FROM ev
WHERE NOT coalesce(snapshot_time = TIMESTAMP '{DELETE_AT}' AND source = '{DELETE_SOURCE}', false)""")
def delete_snapshot(spark, d):
    return OP.delete_snapshot(events_snap(spark, d), DELETE_AT, DELETE_SOURCE)


@register("delete_snapshot_day", _with(EVENTS) + f"""
SELECT * FROM ev
WHERE NOT coalesce(CAST(snapshot_time AS DATE) = DATE '{DELETE_AT[:10]}'
                   AND source = '{DELETE_SOURCE}', false)""")
def delete_snapshot_day(spark, d):
    return OP.delete_snapshot(events_snap(spark, d), DELETE_AT[:10], DELETE_SOURCE, day=True)


@register("delete_child_by_parent_source", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS snapshot_time
FROM lineitem l
WHERE NOT (CAST(l_shipdate AS DATE) = DATE '{CHILD_DELETE_DAY}'
           AND EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                       AND o.o_orderstatus = '{PARENT_SOURCE}'))
   OR l_shipdate IS NULL""")
def delete_child_by_parent_source(spark, d):
    child = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").alias("snapshot_time"))
    parent = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                           F.col("o_orderstatus").alias("source"))
    return OP.delete_child_by_parent_source(child, parent, ["l_orderkey"], CHILD_DELETE_DAY,
                                            PARENT_SOURCE, day=True)


@register("replace_upsert", """
WITH base AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
u AS (
  SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate + INTERVAL 1 DAY AS o_orderdate
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey, 'F', o_totalprice, o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT -o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)),
ud AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1)
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM ud WHERE ud.o_orderkey = b.o_orderkey)
UNION ALL SELECT * FROM ud""")
def replace_upsert(spark, d):
    o = _t(spark, d, "orders")
    base = o.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    pending = base.where(F.col("o_orderstatus") == "P")
    changed1 = pending.select("o_orderkey", F.lit("F").alias("o_orderstatus"), "o_totalprice",
                              (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"))
    changed2 = pending.select("o_orderkey", F.lit("F").alias("o_orderstatus"), "o_totalprice",
                              (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("o_orderdate"))
    li = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    new = base.join(li, "o_orderkey", "left_anti").select(
        (-F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus", "o_totalprice", "o_orderdate")
    updates = changed1.unionByName(changed2).unionByName(new)
    return OP.replace_upsert(base, updates, ["o_orderkey"], [F.col("o_orderdate").desc()])


@register("fk_orphans", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def fk_orphans(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = _t(spark, d, "lineitem")
    return OP.fk_orphans(o, li, {"o_orderkey": "l_orderkey"})


@register("fk_orphan_tracks", _with(SC_FACTS) + """
SELECT t.* FROM sc_tracks t
WHERE NOT EXISTS (SELECT 1 FROM sc_artists a WHERE a.artist_id = t.artist_id
                  AND a.snapshot_time = t.snapshot_time)""")
def fk_orphan_tracks(spark, d):
    tr, ar = wh(spark, d, transform.SOUNDCLOUD, "tracks", "artists")
    return OP.fk_orphans(tr, ar, ["artist_id", "snapshot_time"])


# ---------------------------------------------------------------------------
# Frontier / missing ids
# ---------------------------------------------------------------------------

@register("request_frontier", _with(LINES) + f"""
SELECT DISTINCT user_id AS id, '{URL_TEMPLATE.replace('%s', '')}' || user_id AS url FROM lines
WHERE user_id IS NOT NULL""")
def request_frontier(spark, d):
    docs = sc_docs(spark, d)
    ids = docs.select(CF.json_path_df(docs, "collection", "[*].track.user_id").alias("ids"))
    return OP.request_frontier(ids, "ids", URL_TEMPLATE)


@register("flatten_distinct", _with(LINES) + """
SELECT DISTINCT concat('s', l_suppkey) AS value FROM lines
UNION SELECT DISTINCT concat('c', o_custkey) FROM lines""")
def flatten_distinct(spark, d):
    docs = sp_docs(spark, d)
    nested = docs.select(CF.json_path_df(docs, "items", "[*].track.artists.[*].id").alias("ids"))
    return OP.flatten_distinct(nested, "ids")


@register("missing_ids", _with(LINES) + f"""
SELECT DISTINCT 'missing_artists' AS type, user_id AS id, {RUN_STAMP} AS data_time
FROM lines JOIN supplier ON s_suppkey = user_id WHERE s_acctbal < 0""")
def missing_ids(spark, d):
    docs = sc_docs(spark, d)
    requested = docs.select("data_time", F.explode("collection.track.user_id").alias("id"))
    fetched = M.raw(spark, d, "soundcloud_artists").select("data_time", "id")
    miss = OP.missing_ids(requested, fetched, "id", run=["data_time"])
    return OP.missing_report(miss, "id", "data_time")


@register("missing_reported", _with(LINES) + f"""
SELECT DISTINCT user_id AS id, {RUN_STAMP} AS data_time
FROM lines JOIN supplier ON s_suppkey = user_id WHERE s_acctbal < 0""")
def missing_reported(spark, d):
    """What the reports among the landed artist documents name."""
    return transform.soundcloud_missing(M.raw(spark, d, "soundcloud_artists", alone=True))


@register("request_frontier_of_run", _with(LINES) + f"""
SELECT DISTINCT user_id AS id, '{URL_TEMPLATE.replace('%s', '')}' || user_id AS url FROM lines
WHERE user_id IS NOT NULL AND {RUN_STAMP} = (SELECT max({RUN_STAMP}) FROM lines)""")
def request_frontier_of_run(spark, d):
    """The ids to fetch for one run, the latest with items (S5, S6): its documents only."""
    docs = sc_docs(spark, d)
    last = docs.where(F.size("collection") > 0).agg(F.max("data_time")).first()[0]
    ids = L.read_raw(spark, M.landing_root(spark, d, "soundcloud_top_tracks"), "soundcloud_top_tracks", runtime=last)
    return OP.request_frontier(ids.select(F.col("collection.track.user_id").alias("ids")), "ids", URL_TEMPLATE)


# ---------------------------------------------------------------------------
# JSON paths (X5) over landed JSON text
# ---------------------------------------------------------------------------

_PATH_ORDER = "ORDER BY pos"


@register("json_path_index", _with(RANKED) + """
SELECT concat('/charts/', d.o_orderkey, '/', d.page) AS href, r.track_id AS value
FROM docs d LEFT JOIN ranked r ON r.o_orderkey = d.o_orderkey AND r.page = d.page AND r.pos = 0""")
def json_path_index(spark, d):
    j = json_docs(spark, d)
    return j.select("href", CF.json_path_df(j, "doc", "items.[0].track.id").alias("value"))


@register("json_path_wildcard", _with(RANKED) + f"""
SELECT concat('/charts/', d.o_orderkey, '/', d.page) AS href,
       coalesce(string_agg(r.track_id, ',' {_PATH_ORDER}), '') AS value
FROM docs d LEFT JOIN ranked r ON r.o_orderkey = d.o_orderkey AND r.page = d.page
GROUP BY d.o_orderkey, d.page""")
def json_path_wildcard(spark, d):
    j = json_docs(spark, d)
    return j.select("href", F.array_join(CF.json_path_df(j, "doc", "items.[*].track.id"), ",")
                    .alias("value"))


@register("json_path_nested_wildcard", _with(RANKED) + f"""
SELECT concat('/charts/', d.o_orderkey, '/', d.page) AS href,
       coalesce(string_agg(concat('s', r.l_suppkey, '+c', r.o_custkey), ',' {_PATH_ORDER})
                FILTER (WHERE r.o_orderkey IS NOT NULL), '') AS value
FROM docs d LEFT JOIN ranked r ON r.o_orderkey = d.o_orderkey AND r.page = d.page
GROUP BY d.o_orderkey, d.page""")
def json_path_nested_wildcard(spark, d):
    j = json_docs(spark, d)
    lol = CF.json_path_df(j, "doc", "items.[*].track.artists.[*].id")
    return j.select("href", F.array_join(F.transform(lol, lambda a: F.array_join(a, "+")), ",")
                    .alias("value"))


@register("json_path_slice", _with(RANKED) + f"""
SELECT concat('/charts/', d.o_orderkey, '/', d.page) AS href,
       coalesce(string_agg(r.track_id, ',' {_PATH_ORDER}), '') AS value
FROM docs d LEFT JOIN ranked r ON r.o_orderkey = d.o_orderkey AND r.page = d.page
                          AND r.pos >= 1 AND r.pos < 3
GROUP BY d.o_orderkey, d.page""")
def json_path_slice(spark, d):
    j = json_docs(spark, d)
    return j.select("href", F.array_join(CF.json_path_df(j, "doc", "items.[1:3].track.id"), ",")
                    .alias("value"))


@register("json_path_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_path_props(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", CF.json_path("props", "k", schema="struct<k:bigint>").alias("k"))


# ---------------------------------------------------------------------------
# Text / URL functions
# ---------------------------------------------------------------------------

def _url_sql() -> str:
    q = "&".join(f"{k}={v}" for k, v in URL_PARAMS.items())
    return f"""
WITH u AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '#') > 0 THEN split_part(url, '#', 1) ELSE url END AS base,
         CASE WHEN strpos(url, '#') > 0 THEN substr(url, strpos(url, '#')) ELSE '' END AS frag
  FROM pages)
SELECT page_id, base || CASE WHEN base LIKE '%?' OR base LIKE '%&' THEN ''
                             WHEN strpos(base, '?') > 0 THEN '&' ELSE '?' END
       || 'page=' || page_id || '&{q}' || frag AS url
FROM u"""


@register("build_url", _url_sql())
def build_url(spark, d):
    p = _t(spark, d, "pages")
    params = F.create_map(F.lit("page"), F.col("page_id").cast("string"),
                          *[x for k, v in URL_PARAMS.items() for x in (F.lit(k), F.lit(v))])
    return p.select("page_id", CF.build_url("url", params).alias("url"))


@register("html_extract_all", f"""
SELECT page_id, CAST(len(regexp_extract_all(html, '{LINK_PATTERN}', 1)) AS BIGINT) AS n_links,
       array_to_string(regexp_extract_all(html, '{LINK_PATTERN}', 1), '|') AS links
FROM pages""")
def html_extract_all(spark, d):
    p = _t(spark, d, "pages")
    links = CF.html_extract_all("html", LINK_PATTERN, 1)
    return p.select("page_id", F.size(links).cast("bigint").alias("n_links"),
                    F.array_join(links, "|").alias("links"))


@register("marker_substring", f"""
WITH v AS (
  SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) AS host,
         CASE WHEN strpos(html, '{MARKER}') > 0
              THEN substr(html, strpos(html, '{MARKER}') + {len(MARKER)}, {MARKER_WIDTH}) END AS value
  FROM pages)
SELECT host, page_id, value FROM v WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id DESC) = 1""")
def marker_substring(spark, d):
    p = _t(spark, d, "pages")
    v = p.select("page_id", CF.url_host("url").alias("host"),
                 CF.marker_substring("html", MARKER, MARKER_WIDTH).alias("value"))
    # the last page carrying the marker wins, per host (partial max per task)
    best = v.where(F.col("value").isNotNull()).groupBy("host").agg(
        F.max(F.struct("page_id", "value")).alias("b"))
    return best.select("host", F.col("b.page_id").alias("page_id"), F.col("b.value").alias("value"))


@register("iso_datetime_check", """
WITH t AS (
  SELECT event_id, CASE event_id % 6
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%d')
    WHEN 2 THEN strftime(ts, '%H:%M') WHEN 3 THEN strftime(ts, '%Y')
    WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+07:00' ELSE props END AS text, ts FROM events)
SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 4) THEN 1 ELSE 0 END AS ok,
       CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts)
            WHEN 4 THEN date_trunc('second', ts) - INTERVAL 7 HOUR END AS at
FROM t""")
def iso_datetime_check(spark, d):
    """Mixed texts: with zone, date alone, time alone, year alone, with offset, junk."""
    e = _t(spark, d, "events")
    form = lambda f: F.date_format("ts", f)
    n = F.col("event_id") % 6
    text = (F.when(n == 0, CF.iso_text("ts")).when(n == 1, form("yyyy-MM-dd")).when(n == 2, form("HH:mm"))
            .when(n == 3, form("yyyy")).when(n == 4, F.concat(CF.iso_text("ts", with_zone=False), F.lit("+07:00")))
            .otherwise(F.col("props")))
    t = e.select("event_id", text.alias("text"))
    return t.select("event_id", F.when(CF.is_iso_datetime("text"), 1).otherwise(0).alias("ok"),
                    CF.parse_iso("text").alias("at"))


# ---------------------------------------------------------------------------
# Quality (F8, F10, F12, W13, J7)
# ---------------------------------------------------------------------------

def _rules_sql(table: str, rules: dict[str, str]) -> str:
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {cond}) AS violations FROM {table}"
             for n, cond in rules.items()]
    return "\nUNION ALL ".join(parts)


ARTIST_RULES_SQL = {
    "artist_id_too_long": f"length(artist_id) > {schemas.ID_MAX_LEN}",
    "name_too_long": f"length(name) > {schemas.NAME_MAX_LEN}",
    "source_null": "source IS NULL",
    "source_too_long": f"length(source) > {schemas.SOURCE_MAX_LEN}",
    "followers_negative": "total_followers < 0",
    "followers_overflow": f"total_followers > {schemas.UNSIGNED_INT_MAX}",
}
TRACK_RULES_SQL = {
    "track_id_null": "track_id IS NULL",
    "track_id_too_long": f"length(track_id) > {schemas.ID_MAX_LEN}",
    "name_too_long": f"length(name) > {schemas.NAME_MAX_LEN}",
    "source_null": "source IS NULL",
    "release_date_null": "release_date IS NULL",
    "duration_negative": "duration < 0",
    "popularity_negative": "popularity < 0",
    "artist_id_too_long": f"length(artist_id) > {schemas.ID_MAX_LEN}",
}


@register("quality_artists", _with(SP_TRACKS) + "\n" + _rules_sql("sp_artists", ARTIST_RULES_SQL))
def quality_artists(spark, d):
    return OP.rule_counts(M.table(spark, d, "artists", transform.SPOTIFY), OP.quality.artist_rules())


GENRE_RULES_SQL = {
    "track_id_null": "track_id IS NULL",
    "genre_null": "genre IS NULL",
    "genre_too_long": f"length(genre) > {schemas.GENRE_MAX_LEN}",
}
BOTH = "WITH " + SP_TRACKS.strip() + "," + SC_FACTS.replace(LINES + ",", "")


@register("quality_tracks", BOTH + ", t AS (SELECT * FROM sp_tracks UNION ALL SELECT * FROM sc_tracks)\n"
          + _rules_sql("t", TRACK_RULES_SQL))
def quality_tracks(spark, d):
    return OP.rule_counts(M.table(spark, d, "tracks"), OP.quality.track_rules())


@register("quality_genres", _with(SC_FACTS) + "\n" + _rules_sql("sc_genres", GENRE_RULES_SQL))
def quality_genres(spark, d):
    return OP.rule_counts(M.table(spark, d, "track_genres", transform.SOUNDCLOUD), OP.quality.genre_rules())


@register("quality_rejected", BOTH + ", t AS (SELECT * FROM sp_tracks UNION ALL SELECT * FROM sc_tracks)\n"
          + "SELECT source, track_id, artist_id, snapshot_time, concat_ws(',', "
          + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in TRACK_RULES_SQL.items())
          + ") AS failed FROM t WHERE " + " OR ".join(f"({c})" for c in TRACK_RULES_SQL.values()))
def quality_rejected(spark, d):
    """The tracks a load would keep back, with the rules they break (``check``)."""
    _, bad = OP.quality.check(M.table(spark, d, "tracks"), OP.quality.track_rules())
    return bad.select("source", "track_id", "artist_id", "snapshot_time",
                      F.array_join("failed_rules", ",").alias("failed"))


@register("quality_required", """
WITH j AS (SELECT o.o_orderkey, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_returnflag
           FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM j"
    for c in ["o_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"]))
def quality_required(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey")
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate",
                                         "l_returnflag")
    return OP.null_counts(twin.with_items(o, li), ["o_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"])


@register("artists_filtered", BOTH + """,
a AS (SELECT * FROM sp_artists UNION ALL SELECT * FROM sc_artists)
SELECT source, artist_id, name, CAST(total_followers AS DOUBLE) AS total_followers,
       snapshot_time AS chart_date FROM a
WHERE source = 'soundcloud'
  AND snapshot_time IN (SELECT max(snapshot_time) FROM a GROUP BY CAST(snapshot_time AS DATE))""")
def artists_filtered(spark, d):
    """Artists by optional filters (F3): one given, one absent, one empty."""
    out = reads.artists_at(M.table(spark, d, "artists"), source=transform.SOUNDCLOUD, artist_id="",
                           every_day=True, limit=None)
    return out.withColumn("total_followers", F.col("total_followers").cast("double"))


DOC_RULES_SQL = {
    "text_null": "text IS NULL",
    "n_chars_negative": "n_chars < 0",
    "n_chars_mismatch": "n_chars <> length(text)",
    "text_over_name_width": f"length(text) > {schemas.NAME_MAX_LEN}",
    "source_too_long": f"length(source) > {schemas.SOURCE_MAX_LEN}",
}
PART_RULES_SQL = {
    "name_too_long": f"length(p_name) > {schemas.NAME_MAX_LEN}",
    "type_too_long": f"length(p_type) > {schemas.GENRE_MAX_LEN}",
    "type_null": "p_type IS NULL",
}


@register("quality_length", "\nUNION ALL ".join(
    [f"SELECT 'documents' AS \"table\", '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violations "
     f"FROM documents" for n, c in DOC_RULES_SQL.items()]
    + [f"SELECT 'part', '{n}', count(*) FILTER (WHERE {c}) FROM part" for n, c in PART_RULES_SQL.items()]))
def quality_length(spark, d):
    """Length / NULL / consistency rules over whole document texts and part
    names (one aggregate pass per table)."""
    docs = _t(spark, d, "documents")
    doc_rules = {
        "text_null": F.col("text").isNull(),
        "n_chars_negative": F.col("n_chars") < 0,
        "n_chars_mismatch": F.col("n_chars") != F.length("text"),
        "text_over_name_width": F.length("text") > schemas.NAME_MAX_LEN,
        "source_too_long": F.length("source") > schemas.SOURCE_MAX_LEN,
    }
    part = _t(spark, d, "part")
    part_rules = {
        "name_too_long": F.length("p_name") > schemas.NAME_MAX_LEN,
        "type_too_long": F.length("p_type") > schemas.GENRE_MAX_LEN,
        "type_null": F.col("p_type").isNull(),
    }
    a = OP.rule_counts(docs, doc_rules).select(F.lit("documents").alias("table"), "rule", "violations")
    b = OP.rule_counts(part, part_rules).select(F.lit("part").alias("table"), "rule", "violations")
    return a.unionByName(b)


_REQ_SQL_GROUP = """
SELECT source, track_id, name, release_date, snapshot_time AS chart_date,
       nullif(array_to_string(list_sort(list_distinct(list(artist_id))), ','), '') AS artist_id
FROM (SELECT * FROM sp_tracks UNION ALL SELECT * FROM sc_tracks) t
GROUP BY source, duration, popularity, track_id, name, release_date, snapshot_time"""


@register("quality_required_fields", "WITH " + SP_TRACKS.strip() + "," + SC_FACTS.replace(LINES + ",", "")
          + ", g AS (" + _REQ_SQL_GROUP + ")\n" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM g"
              for c in OP.quality.REQUIRED_TRACK_FIELDS))
def quality_required_fields(spark, d):
    """Required fields of the API track rows (F12), over both sources."""
    tracks = M.table(spark, d, "tracks")
    rows = reads.tracks_at(tracks, all_snapshots=True, limit=None, as_string=True)
    return OP.null_counts(rows, OP.quality.REQUIRED_TRACK_FIELDS)


FLAGSHIP = "tracks_at_snapshot"


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return QUERIES[name](spark, sf_dir)


# the queries over stored state register themselves here
from chartlake.plans import registry_stored  # noqa: E402,F401
