"""The operators' registered queries: thin digests of their results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.llm import bpe, decontam, language_id, licenses, line_crf, line_templates, quality_rules, ranked_search, simhash, substrings, suffix_lm, toxicity, whitening
from clusterfold.sources.tables import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def fold(n: int) -> Column:
    """crc32 of the id's text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(ids, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(fold(7) == 2, F.lit(False))
    found = suffix_lm.fit_and_score(table(spark, sf_dir, "documents"), ~held)
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = line_crf.train(docs, labels, fold(3) != 1)
    found = line_crf.score(docs.select("doc_id", "text"), chain).select(F.col("row.doc_id").alias("doc_id"), "score")
    return found.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontam.scan(docs.select("doc_id", "text"), items)
    n_hit = decontam.n_hit()
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array_distinct("places.label")
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
                        F.array_join(F.array_sort(base), ",").alias("base_labels"),
                        F.array_join(F.array_sort(F.array_union(base, F.col("detections.label"))), ",").alias("labels"), "score")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.train(docs, labels, fold(5) != 0)
    found = toxicity.score(docs, index)
    return found.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 32)
    each = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error", F.posexplode("white").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("at")].alias("explained"), "identity_error")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs, fold(5) != 0))
    return found.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


QUERIES = {q.__name__: q for q in (op1_byte_bpe, op2_simhash, op3_line_templates, op4_quality_rules, op5_suffix_lm,
                                   op6_line_crf, op7_decontaminate, op8_licenses, op9_substrings, op10_toxicity, op11_whitening, op12_language_id, op13_ranked_search)}
