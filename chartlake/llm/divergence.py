"""Source divergence audit: how far the word use of each source lies from the others'.

Run-length columns. For each language the kept terms (in at least
``min_docs`` of its documents) are a column order, each source's counts a
column. Terms with equal counts in every source fall together into one row
with a weight, the rows are sorted by their counts, source by source, largest
source first, so equal counts stand together, and each source's column is
run-length encoded. For a pair of sources the run boundaries are intersected
and the difference of the two smoothed shares is multiplied by the run's
length. The sorted vocabulary is cut into blocks of bounded size, whose sums
add up; sources meet in tiles, so a task holds two tiles' runs of one block.

``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, in whole numbers (digit by
digit in base 1000, exact below 9.2e15 occurrences a group, an error beyond).

Defined results: null text, language and source count as the empty text;
texts without terms still make their (language, source) group; a language
without kept terms has pairs of value 0 and no terms; ties go by the item's
UTF-8 bytes; equal rows count each; an empty table gives no rows; other
columns aren't read. The pairs of a language are as many as its sources
squared, which is the result itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .terms import byte_table, split
from .words import chunks

MIN_DOCS, TOP = 30, 50
#: Distinct count vectors sorted by one task, and entries (a term's count in a source) of one block.
ROWS, ENTRIES = 100_000, 1_000_000
#: Sources of a tile: a task compares two tiles over one block.
TILE = 64

COUNTS = "lang string, source string, term string, n long, docs long"
RUNS = "lang string, block long, number int, lengths array<long>, counts array<long>"
PAIRS = "lang string, a int, b int, value long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (language, source, term), portion by portion."""
    table = byte_table(digits=False)
    for batch in batches:
        for part in chunks(batch, 2):
            terms, codes, offsets = split(part.column(2), table)
            lang, source = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
            lang_of, source_of = lang.indices.to_numpy().astype(np.int64), source.indices.to_numpy()
            group = lang_of * len(source.dictionary) + source_of
            rows = np.repeat(np.arange(part.num_rows), np.diff(offsets))
            wide = max(len(terms), 1)
            found, n = np.unique(group[rows] * wide + codes, return_counts=True)
            once = np.unique(rows * wide + codes)  # each term of a row once
            _, docs = np.unique(group[once // wide] * wide + once % wide, return_counts=True)
            g = found // wide
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(g // max(len(source.dictionary), 1))),
                source.dictionary.take(pa.array(g % max(len(source.dictionary), 1))),
                terms.take(pa.array(found % wide)).cast(pa.string()), pa.array(n, pa.int64()),
                pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def share(count: str, total: str, terms: str) -> str:
    """SQL of p: three steps of long division in base 1000, so no product leaves 64 bits."""
    a, b = f"({count} + 5)", f"({total} + 5 * {terms})"
    second = f"(({a} * 1000) % {b} * 1000)"
    return (f"1 + ({a} * 1000 div {b}) * 1000000 + ({second} div {b}) * 1000 "
            f"+ ({second} % {b} * 1000 div {b})")


def _encode(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of each source in each block of the rows (lang, numbers, counts, weight) of a sorted
    partition; a source of null number stands for those that the block's terms miss."""
    block = TaskContext.get().partitionId() << 32
    held, entries = [], 0
    for batch in batches:
        held.append(batch)
        entries += len(batch.column(1).flatten())
        if entries >= limit:
            for runs in _by_language(held, block):
                yield runs
                block += 1
            held, entries = [], 0
    yield from _by_language(held, block)


def _by_language(held: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """One block for each language of the sorted rows ``held``, numbered from ``block`` on."""
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    codes = rows.column(0).combine_chunks().dictionary_encode().indices.to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(codes)) + 1), rows.num_rows]
    for i in range(len(edges) - 1):
        part = rows.slice(edges[i], edges[i + 1] - edges[i]).combine_chunks().to_batches()[0]
        yield _runs(part, part.column(0)[0].as_py(), block + i)


def _runs(rows: pa.RecordBatch, lang: str, block: int) -> pa.RecordBatch:
    weight = rows.column(3).to_numpy()
    ends = np.cumsum(weight)
    starts = ends - weight
    at = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows.column(1)).to_numpy())
    number, count = rows.column(1).flatten().to_numpy(), rows.column(2).flatten().to_numpy()
    order = np.lexsort((at, number))
    at, number, count = at[order], number[order], count[order]
    numbers, lengths, counts = [None], [[int(ends[-1])]], [[0]]
    for i in np.split(np.arange(len(at)), np.flatnonzero(np.diff(number)) + 1):
        # the places of the source's rows, with the gaps (count 0) before, between and behind
        edges = np.append(np.column_stack([starts[at[i]], ends[at[i]]]).ravel(), ends[-1])
        values = np.append(np.column_stack([np.zeros(len(i), np.int64), count[i]]).ravel(), 0)
        steps = np.diff(edges, prepend=0)
        filled = steps > 0
        steps, values = steps[filled], values[filled]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        numbers.append(int(number[i[0]]))
        lengths.append(np.add.reduceat(steps, first))
        counts.append(values[first])
    n = len(numbers)
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * n), pa.array([block] * n, pa.int64()), pa.array(numbers, pa.int32()),
        pa.array(lengths, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
        names=["lang", "block", "number", "lengths", "counts"])


def intersect(ends_a: np.ndarray, p_a: np.ndarray, ends_b: np.ndarray, p_b: np.ndarray) -> int:
    """Sum of |p_a - p_b| over two run-length columns, given by the ends of their runs."""
    ends = np.union1d(ends_a, ends_b)
    apart = np.abs(p_a[np.searchsorted(ends_a, ends)] - p_b[np.searchsorted(ends_b, ends)])
    return int(apart @ np.diff(ends, prepend=0))


def _pairs(met: pa.Table, tile: int) -> pa.Table:
    """Sums of one block over the pairs of sources of two tiles."""
    lang, low, high = (met.column(c)[0].as_py() for c in ("lang", "low", "high"))
    columns = {}
    for row in range(met.num_rows):
        lengths = np.array(met.column("lengths")[row].values, np.int64)
        columns[met.column("number")[row].as_py()] = (
            np.cumsum(lengths), np.array(met.column("p")[row].values, np.int64))
    found = [(a, b, intersect(*columns[a], *columns[b])) for a in columns if a // tile == low
             for b in columns if b // tile == high and a < b]
    a, b, value = zip(*found) if found else ((), (), ())
    return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                     pa.array(value, pa.int64())], names=["lang", "a", "b", "value"])


def counts_of(docs: DataFrame, lang: Column, source: Column, text: Column, min_docs: int = MIN_DOCS
              ) -> tuple[DataFrame, DataFrame]:
    """Kept terms (lang, source, term, n, lang_n) and groups (lang, source, number, n_group, n_lang,
    n_terms), both written to the shared folder; sources are numbered from the largest on."""
    named = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"),
                        text.alias("text"))
    counts = named.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # at most one row a source
    counts = counts.select("*", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"))
    kept = saved(counts.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"), "kept-terms")
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    largest = Window.partitionBy("lang").orderBy(F.col("n_group").desc(), "source")
    groups = named.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(
        langs, "lang", "left").na.fill(0, ["n_group", "n_lang", "n_terms"])
    return kept, saved(groups.withColumn("number", F.row_number().over(largest) - 1), "source-groups")


def _tops(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """Each group's terms of larger share than in its language, the ``top`` largest differences."""
    rows = kept.join(groups, ["lang", "source"])
    value = F.expr(f"({share('n', 'n_group', 'n_terms')}) - ({share('lang_n', 'n_lang', 'n_terms')})")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where(
        "value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def runs_of(kept: DataFrame, groups: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """The run-length columns: (lang, block, number, lengths, counts), null number as in ``_encode``."""
    cell = F.struct(F.col("number"), F.col("n"))
    terms = kept.join(groups.select("lang", "source", "number"), ["lang", "source"]).groupBy("lang", "term").agg(
        F.array_sort(F.collect_list(cell)).alias("cells"))  # a term has one cell a source
    vectors = saved(terms.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("weight")), "vectors")
    parts = max(1, -(-vectors.count() // ROWS))
    ordered = vectors.repartitionByRange(parts, "lang", "cells").sortWithinPartitions("lang", "cells").select(
        "lang", F.col("cells.number").alias("numbers"), F.col("cells.n").alias("counts"), "weight")
    return ordered.mapInArrow(lambda batches: _encode(batches, entries), RUNS)


def _sums(runs: DataFrame, groups: DataFrame, tile: int) -> DataFrame:
    """(lang, a, b, value) of each pair of sources a < b of a language, by their numbers."""
    stored = saved(runs, "runs")
    blocks = stored.where("number IS NULL").select("lang", "block", F.col("lengths").alias("whole"))
    # every language has one block of no length, so its pairs are there without kept terms as well
    none = groups.select("lang").distinct().select(
        "lang", F.lit(-1).cast("long").alias("block"), F.array().cast("array<long>").alias("whole"))
    columns = blocks.unionByName(none).join(groups, "lang").join(
        stored.where("number IS NOT NULL"), ["lang", "block", "number"], "left")
    columns = columns.select(
        "lang", "block", "number", F.coalesce("lengths", "whole").alias("lengths"),
        F.expr("coalesce(counts, transform(whole, w -> 0L))").alias("counts"), "n_group", "n_terms")
    priced = columns.withColumn("p", F.expr(f"transform(counts, c -> {share('c', 'n_group', 'n_terms')})"))
    last = groups.groupBy("lang").agg(F.max("number").alias("last"))
    tiled = priced.join(last, "lang").select(
        "lang", "block", "number", "lengths", "p", F.expr(f"number div {tile}").cast("int").alias("tile"),
        F.explode(F.expr(f"sequence(0, cast(last div {tile} as int))")).alias("other"))
    met = tiled.select("lang", "block", "number", "lengths", "p", F.least("tile", "other").alias("low"),
                       F.greatest("tile", "other").alias("high"))
    return met.groupBy("lang", "block", "low", "high").applyInArrow(
        lambda met: _pairs(met, tile), PAIRS).groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP, tile: int = TILE, entries: int = ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language
    by the sum of the differences, part ``term`` the terms a source uses more than its language."""
    kept, groups = counts_of(docs, F.col(lang), F.col(source), F.col(text), min_docs)
    sums = _sums(runs_of(kept, groups, entries), groups, tile)
    both = sums.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("of"), F.col("b").alias("to")),
        F.struct(F.col("b").alias("of"), F.col("a").alias("to")))).alias("pair"))
    names = groups.select("lang", "source", "number")
    pairs = both.select("lang", "value", "pair.of", "pair.to").join(
        names.select("lang", "source", F.col("number").alias("of")), ["lang", "of"]).join(
        names.select("lang", F.col("source").alias("item"), F.col("number").alias("to")), ["lang", "to"])
    far = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(far))
    out = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
           for part, rows in (("pair", pairs), ("term", _tops(kept, groups, top)))]
    return out[0].unionByName(out[1])


AUDIT_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d)
      GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}),
t AS (SELECT lang, source, unnest(terms) AS term FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term
      GROUP BY t.lang, t.source, t.term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
gn AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
ln AS (SELECT lang, sum(n) AS n FROM c GROUP BY lang),
lt AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(gn.n, 0) + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (lt.n + 5)) // (ln.n + 5 * v.v) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang JOIN ln ON ln.lang = g.lang
      JOIN lt ON lt.lang = k.lang AND lt.term = k.term
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR rank <= {TOP}"""
