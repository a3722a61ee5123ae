"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (compression_quality, decontaminate, exact_duplicates, hard_negatives, html_text, license_scan, line_runs,
               mixing, near_duplicates, personal_data, quality_rules, url_reputation, whitening)
from .common import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.learn_rules(docs, table(spark, folder, "labels"))
    judged = quality_rules.judge(docs, rules)
    return judged.select("doc_id", *[f"stats.{c}" for c in quality_rules.COUNTS[:5]], "base_failed", "kept", "rule")


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), percent=85)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages").select("page_id", "html"))


def op5_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = compression_quality.fit(docs, table(spark, folder, "labels"))
    return compression_quality.score(docs, model).drop("text")


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return personal_data.find(docs, personal_data.fit(docs)).drop("text")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.interleave(docs).orderBy("mix_slot", "mix_place")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_runs.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


def op10_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_reputation.judge_urls(table(spark, folder, "pages").select("page_id", "url"), table(spark, folder, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bound", 6).alias("bound"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op13_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates.find_copies(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_near_duplicates, op3_decontamination, op4_html_text, op5_compression_quality,
        op6_personal_data, op7_mixing, op8_license_scan, op9_line_dedup, op10_url_reputation,
        op11_hard_negatives, op12_whitening, op13_exact_duplicates)}
