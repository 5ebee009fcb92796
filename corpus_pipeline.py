"""A training corpus from ``documents``: quality rules, line dedup, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared folder and reads it as the next one's documents.

Null and empty texts fail the quality rules and go. Rows may repeat an id: every stage works
on rows, and columns beside those of ``documents`` are carried along (``__near_row`` is taken).
An empty table gives no piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsekit.llm import line_dedup, near_dups, packing, quality_rules, secret_scan
from lapsekit.llm.common import let_workers_import, stored, table

ROW = "__near_row"
NEAR_PERCENT = 80  # similarity of word shingles from which documents of the corpus are near-duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects, as they are."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the three-line passages that stand earlier in the corpus."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id. Every row is a document of
    its own: rows that repeat an id go by their own texts, of fully equal rows one stays, and rows with a null id
    come after all others of their group. Texts without words are in no group and stay."""
    let_workers_import(spark)
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    found = near_dups.near_duplicates(rows.select(ROW, "text"), doc_id=ROW, percent=NEAR_PERCENT)
    groups = found.select(F.col("doc_id").alias(ROW), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW]
    stays = groups.groupBy("component_id").agg(first.alias(ROW), F.count("*").alias("n")).filter("n > 1")
    gone = groups.join(stored(stays.select("component_id", F.col(ROW).alias("stays")), "pipeline-stays"), "component_id")
    gone = stored(gone.filter(F.col(ROW) != F.col("stays")).select(ROW), "pipeline-gone")
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark."""
    let_workers_import(spark)
    field = secret_scan.train(docs)
    return secret_scan.redact(docs, field).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    let_workers_import(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dups", near), ("secret_scan", secrets),
          ("packing", packed)]
ORACLE_SQL = None  # SQL has no form for the near-duplicate, secret and packing stages; tests hold them to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
