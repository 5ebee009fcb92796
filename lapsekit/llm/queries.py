"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsekit.llm import (edit_fingerprints, html_text, line_dedup, near_dups, ngram_join, packing, piece_codec, quality_rules,
                          secret_scan, spelling, url_filters, warc, whitening)
from lapsekit.llm.common import let_workers_import, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_warc(spark, sf_dir):
    """Every page as a record of Zstandard archives, read back and checked."""
    return (warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), with_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query
def op2_near_dups(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_piece_codec(spark, sf_dir):
    """Every document encoded, and whether decoding gives it back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = piece_codec.decode(piece_codec.encode(docs, path), path, into="back")
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
                       F.col("back").eqNullSafe(F.col("text")).alias("round_trip"))


@query
def op4_edit_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return edit_fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark, sf_dir):
    """Every document's pieces with their places in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_url_filters(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    return url_filters.filter_urls(table(spark, sf_dir, "pages")).drop("is_listed")


@query
def op7_quality_rules(spark, sf_dir):
    """Features and verdict of every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query
def op8_line_dedup(spark, sf_dir):
    """Every document without the three-line passages that stand earlier in the corpus."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), removed="removed")
    return done.select("doc_id", F.size("removed").cast("long").alias("n_removed"),
                       F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query
def op9_secret_scan(spark, sf_dir):
    """Secrets of every document: base spans, and all spans with those of the field."""
    spans = F.filter(F.split("spans", ","), lambda s: s != "")
    base = F.filter(spans, lambda s: ~s.startswith("crf:"))

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), "spans")


@query
def op10_html_text(spark, sf_dir):
    """The main text of every page."""
    return (html_text.extract(table(spark, sf_dir, "pages"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


@query
def op11_whitening(spark, sf_dir):
    """The first four whitened components of every usable embedding."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), vec_id="vec_id", vector="embedding", keep=4)
    return white.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_ngram_join(spark, sf_dir):
    """Components of all documents under the Jaccard join of three-word shingles at 90 percent."""
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op13_spelling(spark, sf_dir):
    """Every frequent word of the documents with its form and root."""
    return (spelling.group_variants(table(spark, sf_dir, "documents"))
            .select("word", "form", "root", "n", "n_near", "form_n"))
