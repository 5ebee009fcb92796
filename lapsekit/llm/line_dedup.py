"""Removal of passages that repeat across the corpus, by overlapping three-line windows.

Every run of ``width`` consecutive lines that hold a word is hashed (128 bits of
MD5 over the exact lines). A window whose hash occurs more than once is repeated;
its first occurrence in the order (doc_id, text hash, line) stays, and the lines
under every later occurrence are removed. Overlapping later windows merge: a line
goes once, however many windows cover it. Blank lines are never part of a window
and stay where they are. Shorter documents have no window and stay whole.

Null text stays null, empty text stays empty. Rows that repeat both doc_id and text
are one document: they get the same result. A null doc_id sorts first.

At scale: the first pass reduces (hash -> first place, count) with partial
aggregation, so that a window that a third of the documents share arrives once a
task. The repeated hashes are written out, so both sides of the second join are
plain exchanges, and adaptive execution splits a hot hash over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import let, stored, without_space

WIDTH = 3


def _full_lines(text: Column) -> Column:
    """Structs of (place among all lines, line) of the lines that hold a word."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    return F.filter(lines, lambda x: F.length(without_space(x["line"])) > 0)


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, doc_key, at, lines, h) of every window; ``lines`` are the places that it covers."""
    def cut(full: Column) -> Column:
        def one(k: Column) -> Column:
            part = F.slice(full, k + 1, width)
            return F.struct(F.transform(part, lambda x: x["i"]).alias("lines"),
                            F.unhex(F.md5(F.array_join(F.transform(part, lambda x: x["line"]), "\n"))).alias("h"))
        return F.when(F.size(full) >= width, F.transform(F.sequence(F.lit(0), F.size(full) - width), one))

    return (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("doc_key"),
                        F.explode(let(_full_lines(F.col(text)), cut)).alias("w"))
            .select("doc_id", "doc_key", F.get("w.lines", F.lit(0)).alias("at"), "w.lines", "w.h"))


def later_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The windows that have an equal one earlier in the corpus."""
    w = windows(docs, doc_id, text, width)
    place = F.struct("doc_id", "doc_key", "at")
    seen = w.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = stored(seen.filter(F.col("first") != F.col("last")).select("h", "first"), "repeated-windows")
    return w.join(repeated, "h").filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "doc_key", "lines")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                removed: str | None = None) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; with ``removed``, a column of that
    name gives the places (from 0, among all lines) that were taken out. Other columns stay."""
    covered = (later_windows(docs, doc_id, text, width).groupBy("doc_id", "doc_key")
               .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("places"))
               .select(F.struct("doc_id", "doc_key").alias("__key"), F.col("places").alias("__gone")))
    keyed = docs.withColumn("__key", F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("doc_key")))
    joined = keyed.join(covered, keyed["__key"].eqNullSafe(covered["__key"]), "left").drop("__key")

    def rebuilt(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    new = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(let(F.split(F.col(text), "\n", -1), rebuilt))
    out = joined.withColumn(text, new)
    if removed:
        out = out.withColumn(removed, F.coalesce("__gone", F.array().cast("array<int>")))
    return out.select(*docs.columns, *([removed] if removed and removed not in docs.columns else []))
