"""Hot keys: one key holds a third of all rows; results stay whole and exact."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartlake import operators as OP
from chartlake.plans import reads

N = 30_000


def _tracks(spark):
    # a third of the rows belong to track "hot" (with 3 artists); the rest
    # are spread over 2,000 tracks with 1 artist each; 5 daily snapshots
    ids = spark.range(N)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 2000).cast("string"))).alias("track_id"),
        F.lit("n").alias("name"), F.lit(1).cast("bigint").alias("duration"), F.lit("spotify").alias("source"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("release_date"),
        (F.col("id") % 7).alias("popularity"),
        F.when(hot, F.concat(F.lit("a"), (F.col("id") % 3 + F.col("id") % 9).cast("string")))
         .otherwise(F.lit("solo")).alias("artist_id"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 5 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0))
         .alias("snapshot_time"))


def test_dedupe_hot_key(spark):
    t = _tracks(spark)
    out = OP.dedupe_latest(t, ["snapshot_time", "track_id", "artist_id"], [F.col("popularity").desc()])
    want = t.select("snapshot_time", "track_id", "artist_id").distinct().count()
    assert out.count() == want
    hot = out.where("track_id = 'hot'").collect()
    assert all(r.popularity == 6 for r in hot)


def test_group_concat_hot_track(spark):
    t = _tracks(spark)
    out = reads.tracks_at(t, all_snapshots=True, limit=None, as_string=True).where("track_id = 'hot'")
    lists = {r.artist_id for r in out.collect()}
    assert lists == {"a0,a3,a6"}


def test_genres_of_hot_track_no_pair_blowup(spark):
    t = _tracks(spark)
    genres = t.select("track_id", "snapshot_time", "source").distinct().select(
        "track_id", "snapshot_time", "source", F.explode(F.array(F.lit("pop"), F.lit("rock"))).alias("genre"))
    # duplicate every genre row 3 times: the answer must not change or blow up
    dup = genres.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")).drop("k")
    by_artist = OP.genres_of(dup, t, by="artist_id")
    assert sorted(tuple(r) for r in by_artist.collect()) == [
        (a, g) for a in ("a0", "a3", "a6", "solo") for g in ("pop", "rock")]


def test_latest_of_day_hot_day(spark):
    t = _tracks(spark).withColumn("snapshot_time", F.when(
        F.col("track_id") == "hot", F.lit(dt.datetime(2024, 1, 1, 23)).cast("timestamp_ntz"))
        .otherwise(F.col("snapshot_time")))
    out = OP.latest_of_day(t)
    assert out.where("track_id = 'hot'").count() == N // 3
    # on Jan 1 the hot rows (23:00) are the latest; other days keep their midnight rows
    others = t.where("track_id <> 'hot' AND dayofmonth(snapshot_time) <> 1").count()
    assert out.count() == N // 3 + others


def test_upsert_hot_key(spark):
    base = spark.range(N).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    upd = spark.range(5).select(F.lit(1).alias("k"), (F.col("id") + 10 * N).alias("v"))
    out = OP.replace_upsert(base, upd, ["k"], [F.col("v").desc()])
    assert out.where("k = 1").collect()[0].v == 10 * N + 4
    assert out.where("k = 0").count() == N - N // 3


# --- plans: a key with a third of the rows is split ------------------------------

SPLIT = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
         "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}


@pytest.fixture()
def splitting(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _keys(spark, n=N):
    """(k, v): a third of the rows have k = 0; rows come from several map tasks."""
    return spark.range(n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))


def test_anti_joins_split(spark, splitting):
    fact, keys = _keys(spark), spark.range(N, numPartitions=4).select(F.col("id").alias("k")).where("k % 5 = 1")
    assert "(skew=true)" in _final_plan(OP.delete_by_keys(fact, keys, ["k"]))
    assert "(skew=true)" in _final_plan(OP.fk_orphans(fact, keys, ["k"]))
    child = fact.withColumn("snapshot_time", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    out = OP.delete_child_by_parent_source(child, keys.withColumn("source", F.lit("s")), ["k"], "2024-01-01", "s",
                                           day=True)
    assert "(skew=true)" in _final_plan(out)
    assert out.count() == fact.join(keys, "k", "left_anti").count()


def test_genre_bridge_splits_a_frequent_artist(spark, splitting):
    tracks = _keys(spark).select(F.col("v").cast("string").alias("track_id"), F.col("k").cast("string").alias("artist_id"))
    arts = spark.range(N, numPartitions=4).select(F.col("id").cast("string").alias("id"), F.array(F.lit("g")).alias("genres"))
    out = OP.genre_bridge(tracks, arts, pairs_unique=True)
    assert "(skew=true)" in _final_plan(out)
    assert out.count() == N


def test_orders_with_very_many_items_split(spark, splitting):
    from chartlake.plans import twin
    orders = spark.range(N + 5, numPartitions=4).select(F.col("id").alias("o_orderkey"))
    items = _keys(spark).select(F.col("k").alias("l_orderkey"), "v")
    out = twin.with_items(orders, items)
    assert "(skew=true)" in _final_plan(out)
    assert out.count() == orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").count()


def test_paging_puts_a_hot_order_in_many_tasks(spark, splitting):
    from chartlake.plans import twin
    lines = _keys(spark).select(F.col("k").alias("o_orderkey"), F.lit(dt.datetime(2024, 1, 1)).alias("o_orderdate"),
                                F.col("k").alias("l_orderkey"), "v")
    paged = twin.paged_lines(lines, F.struct("v"))
    sizes = [r["count"] for r in paged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < N / 3  # the hot order alone has N / 3
    hot = paged.where("o_orderkey = 0").groupBy("page").agg(F.count("v").alias("n"), F.min("v").alias("low")).collect()
    assert len(hot) == N // 300 and all(r.n == 100 and r.low == r.page * 300 for r in hot)
