"""Site-relative line removal.

A line is boilerplate on a host when the pages of the host that contain it,
divided by all pages of the host, exceed ``ratio``. Lines are compared after
trimming spaces, tabs and carriage returns; blank lines are never boilerplate.
A line also has to be on ``min_pages`` pages, so a host with a handful of
pages keeps its text.

Per page each distinct line counts once, so counts fold map-side and a line on
every page of a huge host is no hot key. A host has at most (mean lines a
page) / ratio boilerplate lines; that list is joined back by host and salt, so
a host with a third of all pages is spread over ``SALTS`` keys.

Defined results: null text stays null (its page counts for the host), empty
text stays empty; a null host is a host of its own; repeated rows are pages of
their own; pages whose lines are all dropped keep an empty text; an empty
table stays empty; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
RATIO = 0.1
MIN_PAGES = 5
BLANKS = " \t\r"


def _trim(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n")


def boilerplate(df: DataFrame, host: str, text: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, host_pages) of the lines over the ratio."""
    pages = df.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("host_pages"))
    lines = df.select(
        F.col(host).alias("host"),
        F.explode(F.array_distinct(F.transform(_lines(text), _trim))).alias("line"))
    counts = (lines.where(F.col("line") != "").groupBy("host", "line")
              .agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages))
    p = pages.withColumnRenamed("host", "__h")
    return (counts.join(p, F.col("host").eqNullSafe(F.col("__h"))).drop("__h")
            .where(F.col("pages") > F.lit(ratio) * F.col("host_pages")))


def drop_boilerplate(df: DataFrame, host: str, text: str, salt: list[str], ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``df`` with boilerplate lines cut from ``text``; adds n_lines and n_dropped."""
    drop = (boilerplate(df, host, text, ratio, min_pages).groupBy("host")
            .agg(F.collect_set("line").alias("__drop"))
            .withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    pages = df.withColumn("__salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)).cast("int"))
    joined = pages.join(
        drop.withColumnRenamed("host", "__host"),
        F.col(host).eqNullSafe(F.col("__host")) & (F.col("__salt") == F.col("__s")), "left")
    lines = joined.withColumn("__lines", _lines(text)).withColumn(
        "__kept", F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
            F.filter("__lines", lambda x: ~F.array_contains(F.col("__drop"), _trim(x)))))
    n = F.coalesce(F.size("__lines"), F.lit(0))
    return (lines
            .withColumn(text, F.when(F.size("__kept") < F.size("__lines"),
                                     F.array_join("__kept", "\n")).otherwise(F.col(text)))
            .withColumn("n_lines", F.greatest(n, F.lit(0)).cast("long"))
            .withColumn("n_dropped", F.greatest(
                F.coalesce(F.size("__lines") - F.size("__kept"), F.lit(0)), F.lit(0)).cast("long"))
            .drop("__salt", "__s", "__host", "__drop", "__lines", "__kept"))


def line_dedup_sql(pages: str, key: str) -> str:
    """DuckDB form of ``drop_boilerplate`` over a query with ``key``, source and text."""
    return f"""
WITH docs AS ({pages}),
pages AS (SELECT source, count(*) AS host_pages FROM docs GROUP BY source),
lines AS (
  SELECT source, unnest(list_distinct(list_transform(string_split(text, chr(10)),
         lambda x: trim(x, chr(32) || chr(9) || chr(13))))) AS line FROM docs),
counts AS (SELECT source, line, count(*) AS pages FROM lines WHERE line <> ''
           GROUP BY source, line HAVING count(*) >= {MIN_PAGES}),
boiler AS (
  SELECT c.source, list(c.line) AS cut FROM counts c
  JOIN pages p ON c.source IS NOT DISTINCT FROM p.source
  WHERE c.pages > {RATIO}::DOUBLE * p.host_pages GROUP BY c.source),
split AS (
  SELECT d.{key}, d.source, d.text, string_split(d.text, chr(10)) AS ls, coalesce(b.cut, []) AS cut
  FROM docs d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.source),
kept AS (
  SELECT *, list_filter(ls, lambda x: NOT list_contains(cut,
         trim(x, chr(32) || chr(9) || chr(13)))) AS ks FROM split)
SELECT {key}, source,
       CASE WHEN len(ks) < len(ls) THEN coalesce(array_to_string(ks, chr(10)), '') ELSE text END AS text,
       coalesce(len(ls), 0)::BIGINT AS n_lines,
       coalesce(len(ls) - len(ks), 0)::BIGINT AS n_dropped
FROM kept"""


#: Over documents, with the source as host.
LINE_DEDUP_SQL = line_dedup_sql("SELECT doc_id, source, text FROM documents", "doc_id")

#: What is no text in a page, and the tags that begin or end a line of it.
NO_TEXT = "(?is)<(script|style).*?</(script|style)>"
LINE_TAGS = "(?i)</?(p|br|li|ul|div|nav|article|h1|title|head|body|html)[^>]*>"
OTHER_TAGS = "<[^>]*>"
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
PAGES_SQL = line_dedup_sql(f"""SELECT page_id, regexp_extract(url, '{HOST}', 1) AS source,
  regexp_replace(regexp_replace(regexp_replace(html, '{NO_TEXT}', '', 'g'), '{LINE_TAGS}', chr(10), 'g'),
                 '{OTHER_TAGS}', '', 'g') AS text FROM pages""", "page_id")


def page_text(html: Column) -> Column:
    """A page's text, a line for each block."""
    text = F.regexp_replace(F.regexp_replace(html, NO_TEXT, ""), LINE_TAGS, "\n")
    return F.regexp_replace(text, OTHER_TAGS, "")
