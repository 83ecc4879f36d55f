"""Plan assertions: built-in expressions only, pushdown and pruning reach the scan."""
import pytest

from chartlake.plans import registry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_no_cross_join(spark, name):
    plan = _plan(registry.run(spark, name, SF))
    for node in PYTHON_NODES:
        assert node not in plan, f"{name}: {node}"


def test_filters_pushed_to_scan(spark):
    plan = _plan(registry.run(spark, "optional_filters", SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linestatus), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_returnflag:string,l_linestatus:string>" in plan


def test_nested_pruning_through_explode(spark):
    plan = _plan(registry.run(spark, "explode_items", SF))
    # only the two nested fields used after the explode are read
    assert "ReadSchema: struct<href:string,items:array<struct<added_at:string,track:struct<id:string>>>>" in plan


def test_warehouse_reads_prune_source_partition(spark):
    plan = _plan(registry.run(spark, "group_concat", SF))
    assert "PartitionFilters: [isnotnull(source" in plan and "(source#" in plan


def test_dedupe_limits_before_shuffle(spark):
    plan = _plan(registry.run(spark, "dedupe_tracks", SF))
    assert "WindowGroupLimit" in plan


def test_reads_of_one_source_dont_move_it(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("genres_of_artist", "genres_of_track", "artists_of_track"):
            moved = [line for line in _plan(registry.run(spark, name, SF)).splitlines() if "hashpartitioning" in line]
            assert moved and not any("source#" in line for line in moved), name
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_tracks_move_repeated_keys_only(spark):
    from chartlake.plans import materialize as M
    from chartlake.plans import transform
    tables = {(t, s): M._facts(spark, SF, t, s) for t in ("tracks", "artists")
              for s in (transform.SPOTIFY, transform.SOUNDCLOUD)}
    for (name, source), df in tables.items():
        plan = _plan(df)
        assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan, (name, source)
        assert df.count() == M.table(spark, SF, name, source).count()


def test_artists_of_track_moves_pairs_once(spark):
    from chartlake.plans import materialize as M
    from chartlake.plans import reads, transform
    df = registry.run(spark, "artists_of_track", SF)
    assert "HashAggregate" not in _plan(df)
    tables = [M.table(spark, SF, t, transform.SPOTIFY) for t in ("tracks", "artists")]
    assert df.count() == reads.artists_of_tracks(*tables).count()


def test_snapshot_join_cuts_both_sides_before_it_moves_them(spark):
    from chartlake.plans import materialize as M
    from chartlake.plans import transform
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        df = registry.run(spark, "snapshot_join", SF)
        plan = _plan(df).split("== Initial Plan ==")[0]
        assert sum("BroadcastHashJoin" in line and "LeftSemi" in line for line in plan.splitlines()) == 2
        got = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    rows = M.table(spark, SF, "tracks", transform.SPOTIFY).select("track_id", "artist_id", "snapshot_time").collect()
    last = {}
    for r in rows:
        last[r.snapshot_time.date()] = max(r.snapshot_time, last.get(r.snapshot_time.date(), r.snapshot_time))
    assert got == sorted(tuple(r) for r in rows if r.snapshot_time in last.values())
