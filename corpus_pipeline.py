"""The corpus pipeline: five stages over `documents`, each written as Parquet and reread as the next one's input.

1. Quality rules: documents that the base rule or the learned list rejects go.
2. Line dedup: later copies of repeated line runs are deleted; documents left without a word go.
3. MinHash near-dedup: the first document of each group stays (five-word shingles, similarity 0.8 or more).
4. Benchmark decontamination: documents that hold a benchmark item go.
5. Mixing: every document gets its place in the schedule of its source.

Each stage handles null, empty and very long texts, repeated rows, empty tables and extra columns as its operator's
docstring says. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convivio.llm import decontaminate, line_runs, mixing, near_duplicates, quality_rules
from convivio.llm.common import WORD, table
from convivio.session import durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_runs.dedup_lines(docs)
    # n_chars describes the text, so it follows it; a text that lost all its words goes.
    if "n_chars" in docs.columns:
        counted = F.when(F.col("n_cut") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    left = cleaned.filter((F.col("n_cut") == 0) | F.col("text").rlike(WORD))
    return left.select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.interleave(docs)


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mix)]
# The learned list, prefix doubling, MinHash and edit distances have no SQL counterpart; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if name == STAGES[-1][0] else durable(out)
    return docs
