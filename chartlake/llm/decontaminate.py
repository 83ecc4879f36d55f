"""Benchmark decontamination over a distributed positional inverted index.

Words are runs of letters, digits and non-ASCII characters with A-Z lowered.
:func:`index` stores one posting (term, document, position) for each corpus
occurrence of a benchmark term, plus one end posting a document that holds its
word count; the postings are written once to the shared folder.

A window is ``size`` consecutive words of an item (all of a shorter one).
:func:`matches` orders each window's terms from the rarest in the corpus on.
The rarest term's postings, moved back by the term's offset, are the candidate
starts; they are intersected with the second rarest term's moved list, and the
few survivors with all remaining lists at once. With ``slop`` each term may
stand up to that many words from its place (proximity matches).

Only built-in functions run. Benchmark tables are broadcast when, counted
beforehand, they are small; otherwise the same joins shuffle.

Defined results: null and empty texts have no words and are never hit; items
without words have no windows; equal items each count; :func:`report` tells rows
with a null or repeated doc_id apart, so each is judged by its own text (for
:func:`index` a doc_id names one text); empty tables give no matches; other
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_key, keyed, measured, saved

WINDOW_WORDS = 10
#: What separates words before A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The term of end postings; no word holds a space.
END = " end"


def ascii_lower(word: Column) -> Column:
    """A-Z lowered, every other character kept."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def _raw_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the words in order, not yet lowered; a separator at an end leaves no word."""
    raw = df.withColumn("__split", F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS))
    first = F.when(F.element_at("__split", 1) == "", 1).otherwise(0)
    last = F.when(F.element_at("__split", -1) == "", 1).otherwise(0)
    length = F.greatest(F.size("__split") - first - last, F.lit(0))
    return raw.withColumn(out, F.slice("__split", first + 1, length)).drop("__split")


def windows(items: DataFrame, item: str = "item_id", text: str = "text",
            size: int = WINDOW_WORDS) -> DataFrame:
    """(item, wid, len, words): the distinct windows of each item."""
    words = _raw_words(items.select(F.col(item).alias("item"), F.col(text).alias("__text")),
                       "__text", "__w").where(F.size("__w") > 0)
    words = words.select("item", F.transform("__w", ascii_lower).alias("w"))
    n = F.least(F.size("w"), F.lit(size))
    cut = words.withColumn("s", F.explode(F.sequence(F.lit(0), F.size("w") - n))).select(
        "item", n.cast("long").alias("len"), F.slice("w", F.col("s") + 1, n).alias("words"))
    return cut.select("item", F.unhex(F.md5(F.array_join("words", " "))).alias("wid"),
                      "len", "words").distinct()


def index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Stored postings (doc, term, pos) of ``terms``; (doc, END, word count) for every document."""
    words = _raw_words(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("__text")),
                       "__text", "__w")
    each = words.select("doc", F.posexplode(F.concat("__w", F.array(F.lit(END)))).alias("pos", "raw"))
    each = each.select("doc", F.col("pos"), ascii_lower(F.col("raw")).alias("term"))
    wanted = terms.select(F.col("term").alias("__t")).union(
        terms.sparkSession.createDataFrame([(END,)], "__t string"))
    return saved(each.join(measured(saved(wanted, "terms")), F.col("term") == F.col("__t"))
                 .select("doc", "term", "pos"), "postings")


def _expected(found: DataFrame, slots: DataFrame, slop: int) -> DataFrame:
    """Where the given window slots have to stand for each candidate start."""
    w = slots.select(F.col("wid").alias("__wid"), F.col("off"), F.col("term").alias("e_term"), "rank")
    at = found.join(w, F.col("wid") == F.col("__wid")).drop("__wid").withColumn(
        "e_pos", (F.col("start") + F.col("off")).cast("int"))
    if slop:
        at = at.withColumn("e_pos", F.explode(F.sequence(F.col("e_pos") - slop, F.col("e_pos") + slop)))
    return at


def _lists(postings: DataFrame, terms: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of these terms in documents that still have candidates."""
    p = postings.select(F.col("doc").alias("p_doc"), F.col("term").alias("p_term"),
                        F.col("pos").alias("p_pos"))
    t = measured(terms.select(F.col("term").alias("__t")).distinct())
    d = measured(found.select(id_key(F.col("doc")).alias("__d")).distinct())
    return (p.join(t, F.col("p_term") == F.col("__t"), "left_semi")
            .join(d, id_key(F.col("p_doc")) == F.col("__d"), "left_semi"))


def _intersect(found: DataFrame, slots: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Candidates with a posting in each of the given slots."""
    at = _expected(found, slots, slop)
    lists = _lists(postings, slots, found)
    met = at.join(lists, (id_key(F.col("doc")) == id_key(F.col("p_doc")))
                  & (F.col("e_pos") == F.col("p_pos")) & (F.col("e_term") == F.col("p_term")))
    full = (met.select("doc", "wid", "start", "rank").distinct()
            .groupBy("doc", "wid", "start").agg(F.count(F.lit(1)).alias("__met")))
    need = slots.groupBy("wid").agg(F.count(F.lit(1)).alias("__need")).withColumnRenamed("wid", "__wid")
    return full.join(need, (F.col("wid") == F.col("__wid")) & (F.col("__met") == F.col("__need"))
                     ).select("doc", "wid", "start")


def matches(postings: DataFrame, wins: DataFrame, slop: int = 0) -> DataFrame:
    """(doc, wid, start) of every occurrence; with slop, starts by the rarest term's place."""
    counts = (postings.where(F.col("term") != END).groupBy("term")
              .agg(F.count(F.lit(1)).alias("tf")).withColumnRenamed("term", "__t"))
    each = wins.select("wid", "len", "words").distinct().select(
        "wid", "len", F.posexplode("words").alias("off", "term"))
    rarest = Window.partitionBy("wid").orderBy("tf", "off")
    ranked = each.join(counts, F.col("term") == F.col("__t")).select(
        "wid", "len", "off", "term", F.row_number().over(rarest).alias("rank"),
        F.count(F.lit(1)).over(Window.partitionBy("wid")).alias("present"))
    # a window with a term that no document has can't occur
    slots = saved(ranked.where(F.col("present") == F.col("len")).drop("present"), "slots")
    head = measured(slots.where("rank = 1").select(
        "wid", F.col("off").alias("h_off"), F.col("term").alias("h_term")))
    found = postings.join(head, F.col("term") == F.col("h_term")).select(
        "doc", "wid", (F.col("pos") - F.col("h_off")).alias("start"))
    found = saved(found.where(F.col("start") >= 0) if not slop else found, "candidates").distinct()
    singles = measured(slots.where("len = 1").select(F.col("wid").alias("__w")).distinct())
    pairs = measured(slots.where("len = 2").select(F.col("wid").alias("__w")).distinct())
    second = saved(_intersect(found, slots.where("rank = 2"), postings, slop), "second")
    rest = _intersect(second, slots.where("rank > 2"), postings, slop)
    by_wid = F.col("wid") == F.col("__w")
    return (found.join(singles, by_wid, "left_semi")
            .union(second.join(pairs, by_wid, "left_semi")).union(rest))


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Per row: n_words, n_hit, the items with occurring windows and their spans' union."""
    wins = saved(windows(items, size=size), "windows")
    terms = wins.select(F.explode("words").alias("term")).distinct()
    rows, numbered = keyed(docs.select("doc_id", "text"), "doc_id")
    postings = index(rows, terms, "__key")
    lens = wins.select(F.col("wid").alias("__wid"), "len").distinct()
    found = saved(matches(postings, wins).join(measured(lens), F.col("wid") == F.col("__wid"))
                  .select("doc", "wid", "start", "len"), "matches")
    spans = found.groupBy("doc", "start").agg(F.max("len").alias("len"))
    before = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce("past", F.lit(0))))
    hits = (spans.withColumn("past", F.max(end).over(before))
            .groupBy(id_key(F.col("doc")).alias("h_doc")).agg(F.sum(fresh).alias("n_hit")))
    owner = measured(wins.select(F.col("wid").alias("__wid"), F.col("item").cast("string")))
    of = (found.select("doc", "wid").distinct().join(owner, F.col("wid") == F.col("__wid"))
          .groupBy(id_key(F.col("doc")).alias("i_doc"))
          .agg(F.array_sort(F.collect_set("item")).alias("items")))  # at most the benchmark's items
    ends = postings.where(F.col("term") == END).select("doc", F.col("pos").cast("long").alias("n_words"))
    key = id_key(F.col("doc"))
    none = F.array().cast("array<string>")
    out = (ends.join(hits, key == F.col("h_doc"), "left").join(of, key == F.col("i_doc"), "left")
           .select(F.col("doc").alias("doc_id"), "n_words",
                   F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                   F.coalesce("items", none).alias("items")))
    if not numbered:
        return out
    names = rows.select(F.col("__key").alias("__k"), F.col("doc_id").alias("__id"))
    return out.join(names, F.col("doc_id") == F.col("__k")).select(
        F.col("__id").alias("doc_id"), "n_words", "n_hit", "items")
