"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from paylake.llm import (balanced_packing, decontam, doc_tree, fill_middle, mixing, near_dup, packing, pitman_yor, quality_rules,
                         secrets, substring_dedup, toxicity, url_rules)
from paylake.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    led = quality_rules.apply_policy(quality_rules.ledger(docs))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "fail_bits")


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitman_yor.score(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                                    "base_score", "score")


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.copies(docs).select("doc_id", "size", "source_size", "target",
                                      (F.col("size") * F.col("copies")).alias("taken"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return doc_tree.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = balanced_packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_benchmark_decontamination, op3_quality_rules, op4_pitman_yor, op5_token_packing, op6_secret_scan,
    op7_near_duplicates, op8_toxicity, op9_url_rules, op10_source_mixing,
    op11_ranked_search, op12_balanced_packing, op13_fill_in_middle)} | {"pipeline": corpus_pipeline.run}
