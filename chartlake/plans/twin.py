"""Chart documents derived from the driver's TPC-H-style tables.

The test data has no music tables, so each raw collection gets a twin that
Spark derives from the whole given tables (its size grows with them):

* one chart run per order: ``data_time`` = ``o_orderdate`` plus up to 23.5
  hours in half hours by the order's key, so a day has many snapshots and
  runs at half past round up, the last ones into the next day;
* one chart item per line item, track = part, ``added_at`` = ship date;
* artists of an item = its supplier (``s<suppkey>``) and the order's
  customer (``c<custkey>``); an artist's genres = its nation and region;
* SoundCloud: the track's user is the supplier (none for line number 7), its
  genre the part type, and ``release_date`` is absent for lines with return
  flag ``N`` (so the creation time is used) and junk for some others;
* artist documents are "fetched" per run for every artist the run's charts
  name; a SoundCloud fetch fails for suppliers with a negative balance,
  which the missing-ids reports among the documents name;
* some ids and names are over the warehouse's widths, some numbers negative or
  too large, some genres blank, missing or too long, so every rule has rows.

Documents hold at most ``PAGE_SIZE`` items: a longer chart becomes several
pages, so no single document (or task) gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake.functions.time import iso_text
from chartlake.operators.nested import explode_fields

# Fixed value: one chart page holds at most 100 items (the sources' page size).
PAGE_SIZE = 100
#: Items of a page of the twin's charts; orders are short, so their pages are too.
CHART_PAGE = 5
#: Orders with more lines than this are numbered in many tasks.
MANY_LINES = 1000
#: The line number whose SoundCloud track has no user.
NO_USER_LINE = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_stamp(ts) -> "F.Column":
    """Run stamp text as the scheduler writes it: ISO with a UTC offset."""
    return F.concat(iso_text(ts, with_zone=False), F.lit("+00:00"))


def run_time(order_key: str = "o_orderkey", day: str = "o_orderdate") -> "F.Column":
    """When an order's chart ran: half hours into its day, by its key."""
    return F.expr(f"{day} + make_dt_interval(0, 0, cast({order_key} % 48 AS int) * 30)").cast("timestamp_ntz")


def with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``orders LEFT JOIN items`` as an inner join and the orders without items:
    an order with very many items is on the side of an inner join that AQE can split."""
    same = F.col("o_orderkey") == F.col("l_orderkey")
    return orders.join(items, same).unionByName(
        orders.join(items.select("l_orderkey"), same, "left_anti"), allowMissingColumns=True)


def _base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders (``o_orderdate`` is the time of the chart run) and line items, each with the columns used."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", run_time().alias("o_orderdate"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
        "l_returnflag")
    return o, li


def chart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their items and item attributes. The joins move the tables'
    own columns; the long texts are made of them behind the last shuffle."""
    o, li = _base(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    lines = o.join(li.join(p, li.l_partkey == p.p_partkey, "left"), o.o_orderkey == li.l_orderkey)
    # without a part its columns are NULL; only the genre has to know it
    key, part, text = F.col("l_partkey"), F.col("p_partkey"), F.col("l_partkey").cast("string")
    return lines.select(
        "o_orderkey", "o_custkey", "o_orderdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_shipdate", "l_returnflag",
        F.when(key % 13 == 0, F.concat("p_name", F.repeat(F.lit("x"), 101))).otherwise(F.col("p_name")).alias("t_name"),
        (F.col("p_size").cast("bigint") * F.when(key % 17 == 0, -1000).otherwise(1000)).alias("t_duration"),
        F.when(part % 11 == 0, " ").when(part % 11 == 2, F.concat("p_type", F.repeat(F.lit("x"), 60)))
         .when(part % 11 != 1, F.col("p_type")).alias("t_genre"),
        F.when(F.col("l_partkey") % 19 == 0, F.concat(text, F.repeat(F.lit("0"), 32))).otherwise(text).alias("t_id"),
        F.when(F.col("l_quantity") == 50, -50).otherwise(F.col("l_quantity").cast("bigint")).alias("t_popularity"))


def paged_lines(lines: DataFrame, order_key=None, size: int = PAGE_SIZE, counted: DataFrame | None = None) -> DataFrame:
    """Add the ``page`` of every item: documents hold at most ``size`` items.

    An item's page is its place in its order's total order of item content
    (``order_key``, by default that of the Spotify item), divided by ``size``.
    Orders are numbered where the join by order has put their lines, without
    another shuffle; those with more than ``MANY_LINES`` lines in many tasks
    (:func:`_paged_by_range`). ``counted`` is a table with all lines'
    ``l_orderkey`` that is cheaper to count than ``lines``.
    """
    lines = lines.where(F.col("o_orderkey").isNotNull())
    many = ((lines if counted is None else counted).where(F.col("l_orderkey").isNotNull()).groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > MANY_LINES)
            .select(F.col("l_orderkey").alias("__many")))
    keys = item_order() if order_key is None else [order_key]
    if many.isEmpty():
        return _paged_in_place(lines, keys, size)
    same = F.col("o_orderkey") == F.col("__many")
    few = _paged_in_place(lines.join(many, same, "left_anti"), keys, size)
    return few.unionByName(_paged_by_range(lines.join(many, same, "left_semi"), keys, size))


def _paged_in_place(lines: DataFrame, keys: list, size: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("o_orderkey").orderBy(*keys)) - 1
    return lines.withColumn("page", F.floor(place / F.lit(size)).cast("int"))


def _paged_by_range(lines: DataFrame, keys: list, size: int) -> DataFrame:
    """The lines are sorted over all tasks by range of (order, item), so an order
    with a third of all rows lies in many tasks; this is written once, with
    the number of the range, to the shared folder. Counts per order and range
    (a small table) give where each range's numbering starts, and inside a
    range items are counted on.
    """
    from chartlake.session import staging_path
    spark = lines.sparkSession
    keyed = lines.withColumn("__k", F.when(F.col("l_orderkey").isNotNull(), F.struct(*keys)))
    ranged = keyed.repartitionByRange("o_orderkey", "__k").withColumn("__range", F.spark_partition_id())
    path = staging_path(spark, "paged-lines")
    ranged.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    counts = stored.groupBy("o_orderkey", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("o_orderkey").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("o_orderkey").alias("__o"), F.col("__range").alias("__r"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("o_orderkey", "__range").orderBy("__k")
    return (stored.withColumn("__rn", F.row_number().over(inside) - 1)
            .join(starts, (F.col("o_orderkey") == F.col("__o")) & (F.col("__range") == F.col("__r")))
            .withColumn("page", F.floor((F.col("__start") + F.col("__rn")) / F.lit(size)).cast("int"))
            .drop("__k", "__range", "__rn", "__o", "__r", "__start"))


#: What a page keeps of each of its lines: for all four collections, or for the charts of one source.
LINE = ["o_custkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate",
        "t_id", "t_name", "t_duration", "t_popularity", "t_genre"]
SPOTIFY_LINE = ["o_custkey", "l_suppkey", "l_shipdate", "t_id", "t_name", "t_duration", "t_popularity"]
SOUNDCLOUD_LINE = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate",
                   "t_name", "t_duration", "t_popularity", "t_genre"]
#: What :func:`item_order` reads.
ORDERED_BY = ["l_shipdate", "t_id", "t_name", "t_duration", "t_popularity", "l_suppkey", "o_custkey"]


def chart_pages(spark: SparkSession, sf_dir: str, line: list[str] = LINE) -> DataFrame:
    """(o_orderkey, o_orderdate, page, lines) of every chart document, empty charts included:
    what all four collections are made of without moving a line again. The joins move
    the columns that ``line`` and the order of the items need, no others."""
    o, li = _base(spark, sf_dir)
    used = dict.fromkeys(["o_orderkey", "o_orderdate", "l_orderkey", *ORDERED_BY, *line])
    lines = paged_lines(chart_lines(spark, sf_dir).select(*used), size=CHART_PAGE, counted=li)
    page = ["o_orderkey", "o_orderdate", "page"]
    full = lines.groupBy(*page).agg(F.collect_list(F.struct(*line)).alias("lines"))
    none = _paged_in_place(o.where(F.col("o_orderkey").isNotNull()).join(
        li.select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
        ["o_orderdate"], CHART_PAGE)
    empty = none.select(*page, F.array().cast(full.schema["lines"].dataType).alias("lines")).distinct()
    return full.unionByName(empty)


def _docs(paged: DataFrame, item) -> DataFrame:
    """One document per (order, page): its items, sorted by content."""
    has_item = F.col("l_orderkey").isNotNull()
    return paged.groupBy("o_orderkey", "o_orderdate", "page").agg(
        F.array_sort(F.collect_list(F.when(has_item, item))).alias("items"))


def _paged_docs(lines: DataFrame, item) -> DataFrame:
    """Page ``lines`` by ``item`` and build the documents."""
    return _docs(paged_lines(lines, item), item)


def spotify_item(of=F.col):
    artists = F.array(
        F.struct(F.concat(F.lit("s"), of("l_suppkey")).alias("id"),
                 F.concat(F.lit("/artists/s"), of("l_suppkey")).alias("href")),
        F.struct(F.concat(F.lit("c"), of("o_custkey")).alias("id"),
                 F.concat(F.lit("/artists/c"), of("o_custkey")).alias("href")))
    track = F.struct(
        of("t_id").alias("id"),
        of("t_name").alias("name"),
        of("t_duration").alias("duration_ms"),
        of("t_popularity").alias("popularity"),
        artists.alias("artists"))
    return F.struct(iso_text(of("l_shipdate")).alias("added_at"), track.alias("track"))


def item_order() -> list:
    """The order of the Spotify item, field by field: nothing is built to sort lines."""
    return [iso_text("l_shipdate"), "t_id", "t_name", "t_duration", "t_popularity",
            F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("c"), "o_custkey")]


def _items(item):
    """The sorted items of a page's lines (no item is null, so both of Spark's sorts agree; this one isn't interpreted)."""
    return F.sort_array(F.transform("lines", lambda line: item(lambda name: line[name])))


def _pages(spark, sf_dir, pages, line=LINE):
    return chart_pages(spark, sf_dir, line) if pages is None else pages


def spotify_top_tracks(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    docs = _pages(spark, sf_dir, pages, SPOTIFY_LINE)
    return docs.select(
        F.concat(F.lit("/charts/"), F.col("o_orderkey"), F.lit("/"), F.coalesce("page", F.lit(0))).alias("href"),
        F.lit(CHART_PAGE).cast("bigint").alias("limit"),
        F.lit(None).cast("string").alias("next"),
        (F.coalesce("page", F.lit(0)) * CHART_PAGE).cast("bigint").alias("offset"),
        F.lit(None).cast("string").alias("previous"),
        F.size("lines").cast("bigint").alias("total"),
        _items(spotify_item).alias("items"),
        run_stamp("o_orderdate").alias("data_time"))


def _genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> [nation name, region name]."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("nationkey"), F.array("n_name", "r_name").alias("genres"))


def spotify_artists(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    lines = explode_fields(_pages(spark, sf_dir, pages), "lines",
                           {"l_suppkey": "l_suppkey", "o_custkey": "o_custkey"}, keep=["o_orderdate"])
    g = _genres(spark, sf_dir)
    sup_runs = lines.select("o_orderdate", F.col("l_suppkey").alias("key")).distinct()
    cus_runs = lines.select("o_orderdate", F.col("o_custkey").alias("key")).distinct()
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    sa = (sup_runs.join(s, sup_runs.key == s.s_suppkey)
          .join(g, F.col("s_nationkey") == g.nationkey, "left")
          .select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
                  F.struct(F.when(F.col("s_suppkey") % 31 == 0, 5_000_000_000)
                           .otherwise(F.floor("s_acctbal").cast("bigint")).alias("total")).alias("followers"),
                  "genres", run_stamp("o_orderdate").alias("data_time")))
    ca = (cus_runs.join(c, cus_runs.key == c.c_custkey)
          .join(g, F.col("c_nationkey") == g.nationkey, "left")
          .select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), 
                  F.when(F.col("c_custkey") % 29 == 0, F.concat("c_name", F.repeat(F.lit("x"), 101)))
                   .otherwise(F.col("c_name")).alias("name"),
                  F.struct(F.floor("c_acctbal").cast("bigint").alias("total")).alias("followers"),
                  "genres", run_stamp("o_orderdate").alias("data_time")))
    return sa.unionByName(ca)


def soundcloud_item(of=F.col, run="o_orderdate"):
    track = F.struct(
        of("l_partkey").alias("id"),
        of("t_name").alias("title"),
        of("t_duration").alias("duration"),
        F.when((of("l_returnflag") == "A") & (of("l_linenumber") == 6), "unknown")
         .when(of("l_returnflag") != "N", iso_text(of("l_shipdate"))).alias("release_date"),
        run_stamp(run).alias("created_at"),
        of("t_popularity").alias("likes_count"),
        F.when(of("l_linenumber") != NO_USER_LINE, of("l_suppkey")).alias("user_id"),
        of("t_genre").alias("genre"))
    return F.struct(track.alias("track"))


def soundcloud_top_tracks(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    docs = _pages(spark, sf_dir, pages, SOUNDCLOUD_LINE)
    return docs.select(
        F.lit("all-music").alias("genre"), F.lit("top").alias("kind"),
        run_stamp("o_orderdate").alias("last_updated"),
        F.concat(F.lit("charts:"), F.col("o_orderkey"), F.lit(":"), F.coalesce("page", F.lit(0))).alias("query_urn"),
        _items(soundcloud_item).alias("collection"),
        run_stamp("o_orderdate").alias("data_time"))


def soundcloud_users(pages: DataFrame) -> DataFrame:
    """The users and runs of the documents that :func:`soundcloud_top_tracks` makes of ``pages``, and nothing else of them."""
    user = lambda line: F.when(line["l_linenumber"] != NO_USER_LINE, line["l_suppkey"]).alias("user_id")
    return pages.select(F.transform("lines", lambda line: F.struct(F.struct(user(line)).alias("track"))).alias("collection"),
                        run_stamp("o_orderdate").alias("data_time"))


def soundcloud_artists(spark: SparkSession, sf_dir: str, charts: DataFrame | None = None) -> DataFrame:
    """Artist documents of the suppliers each run names (some with a type of
    their own), and reports of those that couldn't be fetched (negative
    balance), one a document so that no run gathers its reports in one row.
    ``charts`` are the landed ``soundcloud_top_tracks``, whose users are fetched, or :func:`soundcloud_users`."""
    docs = soundcloud_top_tracks(spark, sf_dir) if charts is None else charts
    runs = explode_fields(docs, "collection", {"key": "track.user_id"}, keep=["data_time"])
    runs = runs.where(F.col("key").isNotNull()).distinct()
    s = table(spark, sf_dir, "supplier")
    named = runs.join(s, runs.key == s.s_suppkey)
    got = F.col("s_acctbal") >= 0
    return named.select(
        F.when(got, F.col("s_suppkey")).alias("id"), F.when(got, F.col("s_name")).alias("full_name"),
        F.when(got, F.floor("s_acctbal").cast("bigint")).alias("followers_count"),
        F.when(~got, "missing_artists").when(F.col("s_suppkey") % 2 == 0, "user").alias("type"),
        F.when(~got, F.array("s_suppkey")).alias("data"),
        "data_time")
