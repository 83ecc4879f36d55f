"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, decontaminate, divergence, gam, jaccard_join, kneser_ney, langid, licenses, line_dedup, packing,
               sharding, toxicity, whitening)
from .common import held_out, table, unsigned_crc32

SHARDS = 8


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 8 by its id, its slot there, and its shard of 9."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        unsigned_crc32(F.col("text")).alias("text_crc32"))
    dealt = sharding.assign(docs, "doc_id", sharding.equal_shards(SHARDS))
    grown = sharding.assign(dealt, "doc_id", sharding.equal_shards(SHARDS + 1), "grown_shard")
    return sharding.with_slots(grown, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of the ids is held out of learning."""
    docs = table(spark, sf_dir, "documents")
    held = held_out(F.col("doc_id"), 4, 2)
    out = langid.identify(docs.select("doc_id", "lang", "text"), ~held)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability; a seventh of the ids is held out of counting."""
    held = held_out(F.col("doc_id"), 7, 2)
    out = kneser_ney.score(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 4-word shingle similarity 0.85 or more."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), "source", "text", ["doc_id"])
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


def line_dedup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page's text without its host's boilerplate lines."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", line_dedup.HOST, 1).alias("source"),
        line_dedup.page_text(F.col("html")).alias("text"))
    out = line_dedup.drop_boilerplate(pages, "source", "text", ["page_id"])
    return out.select("page_id", "source", "text", "n_lines", "n_dropped")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside occurrences of benchmark windows."""
    out = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; labels of a quarter of the ids are held out."""
    held = held_out(F.col("doc_id"), 4, 2)
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; labels of a third of the ids are held out."""
    held = held_out(F.col("doc_id"), 3, 1)
    out = gam.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's distance to each other source of its language, and the terms it uses most above it."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 32 principal components, at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and the license templates that it holds."""
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score", "matches")


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_ann, op3_langid, op4_kneser_ney, op5_jaccard_join, op6_line_dedup, op7_decontaminate, op8_toxicity, op9_quality,
    op10_packing, op11_divergence, op12_whitening, op13_licenses, line_dedup_pages)}
ORACLE = {"op6_line_dedup": line_dedup.LINE_DEDUP_SQL, "line_dedup_pages": line_dedup.PAGES_SQL,
          "op11_divergence": divergence.AUDIT_SQL}
