import datetime as dt

from pyspark.sql import functions as F

from chartlake import functions as CF
from conftest import rows


def test_round_to_hour_edges(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:29:59.999999",), ("2024-01-01 10:30:00",), ("2024-01-01 23:30:00",),
         ("2024-12-31 23:45:00",), (None,)], "t string")
    out = df.select(CF.round_to_hour(F.col("t").cast("timestamp_ntz")).alias("r"))
    assert out.schema["r"].dataType.typeName() == "timestamp_ntz"
    got = [r.r for r in out.collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 2, 0),
                   dt.datetime(2025, 1, 1, 0), None]


def test_round_to_hour_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([("2024-01-01 10:40:00",)], "t string")
        r = df.select(CF.round_to_hour(F.col("t").cast("timestamp_ntz")).alias("r")).first().r
        assert r == dt.datetime(2024, 1, 1, 11)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_iso_forms(spark):
    df = spark.createDataFrame(
        [("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+07:00",), ("2024-01-01",),
         ("junk",), (None,)], "t string")
    got = [r.r for r in df.select(CF.parse_iso("t").alias("r")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1),
                   None, None]


def test_coalesce_timestamp_chooses_on_null_text(spark):
    df = spark.createDataFrame(
        [(None, "2024-02-02T00:00:00Z"), ("2024-03-03T00:00:00Z", "2024-02-02T00:00:00Z"),
         ("junk", "2024-02-02T00:00:00Z"), (None, None)], "a string, b string")
    got = [r.r for r in df.select(CF.coalesce_timestamp("a", "b").alias("r")).collect()]
    assert got == [dt.datetime(2024, 2, 2), dt.datetime(2024, 3, 3), None, None]


def test_iso_validity(spark):
    df = spark.createDataFrame([("2024-01-01T04:00:00",), ("2024-01-01",), ("2024-13-01",), ("x",)],
                               "t string")
    got = [r.ok for r in df.select(CF.is_iso_datetime("t").alias("ok")).collect()]
    assert got == [True, True, False, False]


def test_unknown_member(spark):
    df = spark.createDataFrame([(None, None), (0, "0"), (5, "abc")], "n bigint, s string")
    out = df.select(CF.unknown_member("n").alias("n"), CF.unknown_member("s").alias("s")).collect()
    assert [tuple(r) for r in out] == [("No Artist", "No Artist"), ("0", "0"), ("5", "abc")]


def test_build_url_separators(spark):
    df = spark.createDataFrame(
        [("http://a.example/x",), ("http://a.example/x?a=b",), ("http://a.example/x#top",),
         ("http://a.example/x?",), ("http://a.example/x?a=b#f",)], "u string")
    one = [r.r for r in df.select(CF.build_url("u", {"k": "v"}).alias("r")).collect()]
    assert one == ["http://a.example/x?k=v", "http://a.example/x?a=b&k=v", "http://a.example/x?k=v#top",
                   "http://a.example/x?k=v", "http://a.example/x?a=b&k=v#f"]
    two = df.select(CF.build_url("u", {"k": "v", "n": 2}).alias("r")).first().r
    assert two == "http://a.example/x?k=v&n=2"
    empty = [r.r for r in df.select(CF.build_url("u", {}).alias("r")).collect()]
    assert empty == [r.u for r in df.collect()]


def test_marker_and_extract(spark):
    df = spark.createDataFrame(
        [('<script crossorigin src="a.js"></script><script crossorigin src="b.js"></script>,client_id:"'
          + "x" * 40,), ("nothing here",)], "h string")
    out = df.select(
        CF.html_extract_all("h", r'<script crossorigin src="([^"]+)"></script>').alias("urls"),
        CF.marker_substring("h", ',client_id:"', 32).alias("m")).collect()
    assert out[0].urls == ["a.js", "b.js"] and out[0].m == "x" * 32
    assert out[1].urls == [] and out[1].m is None


def test_split_list_and_group_concat(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, None), (3, "c"), (3, "c")],
                               "k int, v string")
    g = df.groupBy("k").agg(CF.group_concat("v").alias("c"))
    assert rows(g) == [(1, "a,b"), (2, None), (3, "c")]
    s = g.select("k", CF.split_list("c").alias("l"))
    assert {r.k: r.l for r in s.collect()} == {1: ["a", "b"], 2: [], 3: ["c"]}


def test_same_day_range(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00",), ("2024-01-15 23:59:59",), ("2024-01-16 00:00:00",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.where(CF.same_day("t", "2024-01-15")).count() == 2


def test_build_url_null_inputs(spark):
    df = spark.createDataFrame([("http://a.example/x", None), (None, {"k": "v"})],
                               "u string, m map<string,string>")
    got = [r.r for r in df.select(CF.build_url("u", F.col("m")).alias("r")).collect()]
    assert got == ["http://a.example/x", None]


def test_round_to_hour_holds_its_time_once_and_rounds_early_times(spark):
    rounded = CF.round_to_hour(CF.parse_iso("t"))
    assert str(rounded).count("try_to_timestamp") == 1
    df = spark.createDataFrame([("1969-12-31 23:29:59",), ("1969-12-31 23:30:00",), ("0001-01-01 00:29:00",)], "t string")
    assert [r.r for r in df.select(rounded.cast("string").alias("r")).collect()] == [
        "1969-12-31 23:00:00", "1970-01-01 00:00:00", "0001-01-01 00:00:00"]
