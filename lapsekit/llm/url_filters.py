"""URL filters: prefix rules, and a Bloom filter cascade for listed domains (DataFrame functions only).

Cascade: level 0 is a Bloom filter of the listed keys; level 1 encodes those keys
of the corpus that are not listed but pass level 0; level 2 the listed keys that
pass level 1; and so on until no false positive is left. The levels are built over
the corpus's complete key universe, so walking them answers membership exactly for
every key of the corpus, from a few bits a key and without a join over the rows.

The filters are built by Spark (``bitmap_construct_agg``) and enter the plan as
binary literals. Their size is checked against ``max_bytes`` before they are built;
a list beyond that is answered by a plain semi-join instead.

Null urls and urls without ``://`` have an empty host and path: no rule fits and
no key is listed. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import LOWER, UPPER, let, stored

#: (rule, verdict): host, then a path prefix. The longest rule that fits wins.
RULES: tuple[tuple[str, str], ...] = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"))
#: Domains whose pages, their subdomains' included, are blocked where no rule speaks.
LISTED: tuple[str, ...] = tuple(f"{name}.example.{top}" for name in (
    "ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x") for top in ("com", "net", "org"))
BITS_PER_KEY, HASHES, CHUNK = 8, 4, 32768
MAX_BYTES = 8 << 20  # of all levels together; beyond it the join is taken


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(h: Column, p: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct of the longest fitting rule and its verdict, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        top, _, prefix = rule.partition("/")
        fits = ((h == top) | h.endswith(f".{top}")) & p.startswith(f"/{prefix}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domains(h: Column, most_labels: int) -> Column:
    """The host and its parent domains, of at most ``most_labels`` labels (no listed key has more)."""
    def suffixes(parts: Column) -> Column:
        n = F.size(parts)
        return F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most_labels))),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    return F.when(F.length(h) == 0, F.array().cast("array<string>")).otherwise(let(F.split(h, "\\.", -1), suffixes))


def _places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(HASHES)]


def passes(key: Column, level: int, filt: bytes) -> Column:
    """Whether all the key's bits are set in the filter."""
    out = F.lit(True)
    for at in _places(key, level, len(filt) * 8):
        byte = F.conv(F.hex(F.substring(F.lit(filt), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        out = out & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return out


def bloom(keys: DataFrame, level: int, n: int) -> bytes:
    """The filter of the column ``key`` of ``keys`` (n rows), built by Spark in chunks of 4 KB."""
    bits = -(-max(n, 1) * BITS_PER_KEY // CHUNK) * CHUNK
    at = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("at"))
    chunks = (at.groupBy((F.col("at") / CHUNK).cast("int").alias("chunk"))
              .agg(F.bitmap_construct_agg(F.col("at") % CHUNK).alias("bitmap")).collect())
    out = bytearray(bits // 8)
    for r in chunks:  # at most bits / CHUNK rows
        out[r["chunk"] * (CHUNK // 8):(r["chunk"] + 1) * (CHUNK // 8)] = r["bitmap"][:CHUNK // 8]
    return bytes(out)


def cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[bytes] | None:
    """The levels for distinct ``listed`` keys over the distinct keys of ``universe`` (both: column
    ``key``); None where they would take more than ``max_bytes``."""
    inside = stored(universe.join(listed, "key", "left_semi"), "listed-keys")
    outside = stored(universe.join(listed, "key", "left_anti"), "other-keys")
    levels: list[bytes] = []
    encode, others = inside, outside
    while n := encode.count():
        if (n * BITS_PER_KEY + CHUNK) // 8 + sum(map(len, levels)) > max_bytes:
            return None
        filt = bloom(encode, len(levels), n)
        wrong = stored(others.filter(passes(F.col("key"), len(levels), filt)), "false-positives")
        levels.append(filt)
        encode, others = wrong, encode
    return levels


def is_member(key: Column, levels: Sequence[bytes]) -> Column:
    """Walks the levels: the first that the key does not pass tells on which side it is."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~passes(key, i, levels[i]), F.lit(i % 2 == 1)).otherwise(out)
    return out


def filter_urls(pages: DataFrame, listed: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
                url: str = "url", keep: Sequence[str] = ("page_id",), max_bytes: int = MAX_BYTES) -> DataFrame:
    """Columns ``keep``, host, path, rule, is_listed and verdict of every row of ``pages``.

    ``listed``: DataFrame with the column ``key`` of blocked domains (default: ``LISTED``).
    """
    spark = pages.sparkSession
    if listed is None:
        listed = spark.createDataFrame([(k,) for k in LISTED], "key string")
    listed = listed.select(F.translate("key", UPPER, LOWER).alias("key")).filter(F.length("key") > 0).distinct()
    most = listed.agg(F.max(F.size(F.split("key", "\\.", -1)))).first()[0] or 1
    u = F.col(url)
    rows = pages.select(*keep, host(u).alias("host"), path(u).alias("path"))
    hosts = rows.select("host").distinct()
    universe = hosts.select(F.explode(domains(F.col("host"), most)).alias("key")).distinct()
    levels = cascade(listed, universe, max_bytes)
    if levels is not None:
        hit = F.exists(domains(F.col("host"), most), lambda k: is_member(k, levels))
        rows = rows.withColumn("is_listed", hit)
    else:  # the list outgrows a literal: the same answer by joining the distinct hosts
        hits = (hosts.select("host", F.explode(domains(F.col("host"), most)).alias("key"))
                .join(listed, "key", "left_semi").select("host").distinct())
        rows = (rows.join(stored(hits, "listed-hosts").withColumn("is_listed", F.lit(True)), "host", "left")
                .withColumn("is_listed", F.coalesce("is_listed", F.lit(False))))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (rows.withColumn("__fit", fit)
            .select(*keep, "host", "path", F.col("__fit.rule").alias("rule"), "is_listed",
                    F.coalesce(F.col("__fit.verdict"), F.when(F.col("is_listed"), "block").otherwise("allow"))
                    .alias("verdict")))
