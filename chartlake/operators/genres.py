"""Track-genre bridge and genre read operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.operators.dedupe import dedupe_latest


def genre_bridge(tracks: DataFrame, artists_raw: DataFrame, along: Sequence[str] = (),
                 artist_key: str = "id", genres_col: str = "genres",
                 pairs_unique: bool = False, dedupe=dedupe_latest) -> DataFrame:
    """``(track_id, genre, *along)``: each track inherits its artists' genres.

    ``along`` are columns both sides share and must match on (e.g. the
    snapshot). Raw artists are deduplicated per key first (a retried fetch
    stores an artist twice), the track side is reduced to distinct
    ``(track, artist)`` pairs, and the result is distinct - so neither side's
    duplicates fan out through the join. ``pairs_unique`` skips the pair
    distinct (and its shuffle) when ``tracks`` is already unique on
    ``(track_id, artist_id, *along)`` - the deduplicated transform output
    and the warehouse table are, by their key. ``dedupe`` (rows, keys, order)
    folds the raw artists.
    """
    along = list(along)
    pairs = tracks.select("track_id", "artist_id", *along).where(F.col("artist_id").isNotNull())
    if not pairs_unique:
        pairs = pairs.distinct()
    arts = dedupe(artists_raw.select(F.col(artist_key).alias("artist_id"), genres_col, *along),
                  ["artist_id", *along], [F.size(genres_col).desc()])
    # null-safe keys: the join shuffles the folded artists once more, by its
    # own keys, and so AQE can split the tracks of a very frequent artist
    on = ["artist_id", *along]
    arts = arts.select(*[F.col(c).alias(f"__a_{c}") for c in on], genres_col)
    same = [F.col(c).eqNullSafe(F.col(f"__a_{c}")) for c in on]
    return (pairs.join(arts, same, "inner")
                 .select("track_id", F.explode(genres_col).alias("genre"), *along)
                 .where(F.col("genre").isNotNull())
                 .distinct())


def genres_of(track_genres: DataFrame, tracks: DataFrame, by: str = "track_id",
              along: Sequence[str] = ("snapshot_time", "source"), value=None,
              distinct: bool = True) -> DataFrame:
    """Distinct ``(by, genre)`` through the tracks table (``by`` = track_id
    or artist_id); ``value`` restricts to one id (pushed below the join).

    For ``by='track_id'`` the tracks side is only an existence check (a
    semi-join). For ``by='artist_id'`` both tables, unique by their keys, are
    joined on the track and folded by one distinct; no member list is
    gathered, so a track with any number of artists is as good as another.
    NULL ids and genres are not members. ``distinct=False`` leaves repeats for
    a consumer that folds them anyway (``genres_list``'s ``collect_set``).
    """
    keys = ["track_id", *along]
    g = track_genres.where(F.col("genre").isNotNull()).select(*keys, "genre")
    t = tracks
    if value is not None:
        t = t.where(F.col(by) == F.lit(value))
        if by == "track_id":
            g = g.where(F.col("track_id") == F.lit(value))
    if by == "track_id":
        out = g.join(t.select(*keys), keys, "left_semi").select("track_id", "genre")
    else:
        members = t.where(F.col(by).isNotNull()).select(*keys, by)
        out = g.join(members, keys, "inner").select(by, "genre")
    return out.distinct() if distinct else out


def genres_list(pairs: DataFrame, by: str, sep: str | None = None) -> DataFrame:
    """``(by, genres)`` sorted distinct genre list per key.

    The set per key is bounded by the number of distinct genres, and
    ``collect_set`` de-duplicates map-side, so a hot key never gathers its
    rows in one task. ``sep`` returns a joined string instead of an array.
    """
    arr = F.array_sort(F.collect_set("genre"))
    out = arr if sep is None else F.array_join(arr, sep)
    return pairs.groupBy(by).agg(out.alias("genres"))


def distinct_genres(track_genres: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Distinct genre names; optionally merging case/accent variants."""
    g = F.col("genre")
    if case_insensitive:
        g = g.cast("string collate UNICODE_CI_AI")
    return track_genres.select(g.alias("genre")).where(F.col("genre").isNotNull()).distinct()


#: Case and accents don't tell two genres apart; ids are compared byte by byte all the same.
GENRE_COLLATION = "UNICODE_CI_AI"


def same_genre(genre, name) -> Column:
    """The genre is ``name``, written in any case and with any accents."""
    left, right = (F.collate(F.col(c) if isinstance(c, str) else c, GENRE_COLLATION) for c in (genre, name))
    return left == right


def folded_genres(track_genres: DataFrame) -> DataFrame:
    """``(genre)``: one spelling of each genre, the first in byte order, whatever its case and accents."""
    named = track_genres.where(F.col("genre").isNotNull())
    return named.groupBy(F.collate("genre", GENRE_COLLATION).alias("__fold")).agg(
        F.min("genre").alias("genre")).select("genre")


def with_folded_genre(rows: DataFrame, genres: DataFrame, column: str = "genre") -> DataFrame:
    """``rows`` with ``column`` in the spelling of ``genres`` (unique under the collation); rows whose
    genre isn't there go. A small side is left to Spark to broadcast."""
    side = genres.select(F.col("genre").alias("__genre"))
    out = rows.join(side, same_genre(F.col(column), F.col("__genre")))
    return out.withColumn(column, F.col("__genre")).drop("__genre")


def folded_genres_of(track_genres: DataFrame, tracks: DataFrame, by: str = "track_id",
                     along: Sequence[str] = ("snapshot_time", "source"), value=None) -> DataFrame:
    """:func:`genres_of` with the genres folded: distinct ``(by, genre)``, genres under their collation."""
    pairs = genres_of(track_genres, tracks, by, along, value)
    return pairs.groupBy(by, F.collate("genre", GENRE_COLLATION).alias("__fold")).agg(
        F.min("genre").alias("genre")).select(by, "genre")
