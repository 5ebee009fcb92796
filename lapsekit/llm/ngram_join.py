"""Jaccard join of documents on word n-grams: size-banded tiles, bitmap signatures, exact intersection.

A document's set is its distinct shingles of three words (A-Z lower-cased; a shorter
document's whole sequence is its one shingle). Documents link where
100 * |intersection| >= percent * |union| (90 if not given, at least 50). The result is
exact: every pair that may link meets in a tile.

1. Documents with the same set are one class: copies are combined before anything is compared.
2. Sizes are cut into bands so wide that the partners of a band's sizes lie in it or in the
   next band. Every class belongs to its band's tiles and, where it may be the larger partner,
   to those of the band below.
3. Comparing all classes of a band would be quadratic in the corpus, so a band is cut into
   tiles: with D the largest symmetric difference that a linked pair of the band can have, the
   hash range is dealt into D + 1 parts. A linked pair must agree in at least one whole part,
   so a tile is the classes of a band that agree in a part, which, at about nine shingles a
   part, hardly any others do.
4. Classes that share a tile get their sets and a bitmap, one bit a shingle hash (folded to the
   narrower width of a pair). Bits that differ are shingles that differ, so their count bounds the
   overlap from above; pairs whose bound lies below the threshold end there.
5. Those left are decided by the exact intersection of their sorted arrays.
6. Tiles are first compared with their first member only, and links are contracted to
   components. Tiles of three members or more that still hold several components are dealt to
   blocks of ``BLOCK`` members, and every two blocks are compared in one step of a task, by
   component, size and bitmap; what passes goes to step 5. This is done for a sample of the tiles
   first, then for the rest: large groups grow together in the first rounds, and their other tiles
   need no comparison any more. Tiles with the same members count once. None is dropped.

Texts that are null, empty or only space have an empty set and link with nothing. Rows are the
documents: a doc_id may repeat, and each row goes by its own text. Rows with a null doc_id
take part; a component of such rows alone has a null id. Sets are held as 64-bit hashes of
their shingles. An empty table gives no row. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import drop_stored, map_slices, stored
from lapsekit.llm.near_dups import components, mix, shingle_set

WORDS = 3
PERCENT = 90
LOWEST = 50
STEP = 125  # percent: a band's largest size to that of the band below, where the threshold asks for no more
BITS = 8  # bits of a bitmap for a shingle, to the next power of two
NARROW, WIDE = 64, 1 << 17  # bits of the smallest and the largest bitmap
BLOCK = 256  # members of a tile that are compared with each other or with as many others at once
ROUNDS = ((0, 1), (1, 8), (8, 64))  # of 64 shares of the tiles
SLOTS = 1 << 26  # hash slots, one bit each (8 MB), that are broadcast to leave rows out of a shuffle
CHUNK = 1 << 15  # bits of one bitmap as Spark builds it
_P = np.uint64(0x9E3779B97F4A7C15)


# ---- 2. and 3. bands and tiles -----------------------------------------------------------
def larger(size: int, percent: int) -> int:
    """The largest size of a partner of a set."""
    return 100 * size // percent


@cache
def band_tops(percent: int) -> list[int]:
    """The largest size of each band, for sizes up to 2^40."""
    if not LOWEST <= percent <= 100:
        raise ValueError(f"percent must be from {LOWEST} to 100, not {percent}")
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, larger(tops[-1], percent), tops[-1] * STEP // 100))
    return tops


def parts(band: int, percent: int) -> int:
    """The number of parts of a band's sets: one more than a linked pair's largest symmetric difference."""
    top = band_tops(percent)[band]
    return (top + larger(top, percent)) * (100 - percent) // (100 + percent) + 1


def bands_of(size: int, percent: int) -> list[int]:
    """The bands in whose tiles a set of this size takes part; bands that only equal sets can link in are left out."""
    tops = band_tops(percent)
    own = bisect_left(tops, size)
    below = [own - 1] if own and size <= larger(tops[own - 1], percent) else []
    return [b for b in [*below, own] if parts(b, percent) > 1]


def tile_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """The tiles of a non-empty sorted set: one for each of its bands and each part of the band's hash range."""
    out = [np.empty(0, np.uint64)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s), dtype=np.uint64)])
    for band in bands_of(len(s), percent):
        k = parts(band, percent)
        part = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # ascending, as s is
        ends = np.searchsorted(part, np.arange(k + 1, dtype=np.uint64))
        place = np.arange(k, dtype=np.uint64) + (np.uint64(band + 1) << np.uint64(40))
        out.append(mix((sums[ends[1:]] - sums[ends[:-1]]) ^ mix(place * _P)))
    return np.concatenate(out)


# ---- 4. bitmaps ----------------------------------------------------------------------------
def bitmap(s: np.ndarray) -> np.ndarray:
    """The bitmap of a set as 64-bit words."""
    width = min(max(NARROW, 1 << (BITS * len(s) - 1).bit_length()), WIDE)
    bits = np.zeros(width, bool)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap at a narrower width."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def may_link(na, nb, differing, percent: int):
    """Whether the overlap's upper bound, from the number of differing bits, reaches the threshold."""
    overlap = (na + nb - differing) // 2
    return 100 * overlap >= percent * (na + nb - overlap)


# ---- documents and classes -----------------------------------------------------------------
def _shapes(part: dict, percent: int) -> dict:
    sets = [shingle_set(t, WORDS) for t in part["text"]]
    return {"rid": part["rid"], "doc_id": part["doc_id"], "row_key": part["row_key"], "n": [len(s) for s in sets],
            "set_id": [_set_id(s) for s in sets],
            "tiles": [tile_keys(s, percent).view(np.int64) if len(s) else None for s in sets]}


def _set_id(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def shapes(docs: DataFrame, percent: int) -> DataFrame:
    """(rid, doc_id, row_key, n, set_id, tiles) of every row; rid is unique, as written."""
    numbered = docs.withColumn("rid", F.monotonically_increasing_id())
    return stored(map_slices(numbered, "rid long, doc_id long, row_key long, n long, set_id binary, tiles array<long>",
                             lambda part: _shapes(part, percent)), "join-shapes")


def sharing(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be one of ``keys`` (of the same name): those with the hash slot of one. A bit for
    each of ``SLOTS`` slots is broadcast, whatever the number of keys; an exact join follows, with less to shuffle."""
    slot = F.pmod(F.xxhash64(column), F.lit(SLOTS))
    chunk, place = F.shiftright(slot, 15).cast("int"), slot.bitwiseAND(CHUNK - 1)
    taken = keys.select(chunk.alias("chunk"), place.alias("place")).groupBy("chunk").agg(
        F.bitmap_construct_agg("place").alias("taken"))
    byte = F.conv(F.hex(F.substring("taken", F.shiftright("place", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (df.withColumns({"chunk": chunk, "place": place}).join(F.broadcast(taken), "chunk")
            .filter(F.getbit(byte, F.col("place").bitwiseAND(7).cast("int")) == 1).drop("chunk", "place", "taken"))


def sets_in_tiles(classes: DataFrame, ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(rid, n, bits, s) of the classes with one of ``ids``, from the text of one of their rows."""
    def own(part: dict) -> dict:
        out: dict = {"rid": [], "n": [], "bits": [], "s": []}
        for rid, text, set_id in zip(part["rid"], part["text"], part["set_id"], strict=True):
            s = shingle_set(text, WORDS)
            if _set_id(s) == set_id:  # row_key is a hash: another text may have it
                for name, value in (("rid", rid), ("n", len(s)), ("bits", bitmap(s).tobytes()), ("s", s.tobytes())):
                    out[name].append(value)
        return out

    wanted = stored(classes.join(ids, "rid", "left_semi"), "join-ids")
    texts = sharing(docs.select("row_key", "text"), "row_key", wanted).join(wanted, "row_key")
    texts = texts.dropDuplicates(["row_key", "rid", "text"])  # repeated rows; partitioned by row_key already
    return stored(map_slices(texts, "rid long, n long, bits binary, s binary", own), "join-sets")


class _Graph:
    """The components of the classes found so far; ``sets`` has those that share a tile."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent, self.labels = sets, percent, None

    def label(self, df: DataFrame, id_col: str, into: str) -> DataFrame:
        """``df`` with the component of ``id_col``."""
        if self.labels is None:
            return df.withColumn(into, F.col(id_col))
        found = self.labels.select(F.col("id").alias(id_col), F.col("component").alias(into))
        return df.join(found, id_col, "left").withColumn(into, F.coalesce(into, id_col))

    def link(self, pairs: DataFrame, bounded: bool) -> None:
        """Join the components of the pairs (a, b) that link; ``bounded``: their bitmaps were compared."""
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .filter("a <> b").distinct(), "join-pairs")
        if not bounded:
            all_pairs, pairs = pairs, stored(self._bounded(pairs), "join-pairs")
            drop_stored(all_pairs)
        if pairs.isEmpty():
            return
        links = self._linked(pairs)
        ends = self.label(self.label(links, "a", "ca"), "b", "cb")
        new = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        drop_stored(links, pairs)
        if new is None:
            return
        if self.labels is not None:
            moved = new.select(F.col("id").alias("component"), F.col("component").alias("c2"))
            old = self.labels.join(moved, "component", "left").select("id", F.coalesce("c2", "component").alias("component"))
            new = new.join(self.labels, "id", "left_anti").unionByName(old)
        self.labels = stored(new, "join-labels")

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        percent = self.percent

        def passing(part: dict) -> dict:
            out: dict = {"a": [], "b": []}
            for a, b, na, nb, x, y in zip(*(part[c] for c in ("a", "b", "na", "nb", "bits_a", "bits_b")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                if may_link(na, nb, int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()), percent):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        ends = {c: self.sets.select(F.col("rid").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits_{c}"))
                for c in "ab"}
        fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        return map_slices(pairs.join(ends["a"], "a").join(ends["b"], "b").filter(fits), "a long, b long", passing)

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link by their sets."""
        percent = self.percent

        def linked(part: dict) -> dict:
            out: dict = {"a": [], "b": []}
            for a, b, x, y in zip(part["a"], part["b"], part["sa"], part["sb"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        ends = {c: sharing(self.sets.select(F.col("rid").alias(c), F.col("s").alias(f"s{c}")), c, pairs) for c in "ab"}
        both = pairs.join(ends["b"], "b").join(ends["a"], "a").select("a", "b", "sa", "sb")
        return stored(map_slices(both, "a long, b long", linked), "join-links")


# ---- 6. tiles ------------------------------------------------------------------------------
def pairs_in_blocks(tiles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs of different components that meet in one of the tiles (key, rid, size, c) and pass
    the bitmap bound. Each member goes to one comparison for every block of its tile, and a comparison
    holds two blocks, so none grows with the tile."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            found = list(_passing(held, percent))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
        at, held = None, []
        for batch in batches:
            for *key, block, rid, c, n, bits in zip(*(batch[x].to_pylist() for x in (
                    "key", "lo", "hi", "block", "rid", "c", "n", "bits")), strict=True):
                if key != at:
                    if len(held) > 1:
                        yield done()
                    at, held = key, []
                held.append((block, rid, c, n, bits))
        if len(held) > 1:
            yield done()

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = tiles.join(sharing(sets.select("rid", "n", "bits"), "rid", tiles), "rid").withColumn(
        "block", F.pmod(F.xxhash64("rid"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = stored(dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                                "rid", "c", "n", "bits"), "join-blocks")
    tasks = max(dealt.sparkSession.sparkContext.defaultParallelism, -(-dealt.count() // 5_000))
    found = stored(dealt.repartition(tasks, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
                   .mapInArrow(compare, "a long, b long"), "join-found")
    drop_stored(dealt)
    return found


def _passing(held: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of two blocks (or within one) of different components that pass the bitmap bound."""
    block, rid, c, n = (np.array([h[k] for h in held]) for k in range(4))
    bits = [np.frombuffer(h[4], np.uint64) for h in held]
    words = min(map(len, bits))
    table = np.stack([folded(x, words) for x in bits])
    first = np.flatnonzero(block == block.min())
    second = first if block.min() == block.max() else np.flatnonzero(block != block.min())
    for i in first:
        js = second[(c[second] != c[i]) & ((rid[second] > rid[i]) | (second is not first))]
        js = js[100 * np.minimum(n[i], n[js]) >= percent * np.maximum(n[i], n[js])]
        if len(js):
            differing = np.bitwise_count(table[js] ^ table[i]).sum(axis=1).astype(np.int64)
            for j in js[may_link(n[i], n[js], differing, percent)]:
                yield int(rid[i]), int(rid[j])


def link_all(classes: DataFrame, tiles: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the classes (rid, row_key, set_id), with their tiles (rid, tiles), that link to another;
    None if there are none."""
    inside = tiles.select("rid", F.explode("tiles").alias("key"))
    heads = stored(inside.groupBy("key").agg(F.min("rid").alias("first"), F.max("rid").alias("last"),
                                             F.count("*").alias("size")).filter("size > 1"), "join-heads")
    crowded = heads.filter("size > 2").select("key", "first", "size")
    members = stored(sharing(inside, "key", crowded).join(crowded, "key"), "join-members")
    pairs = heads.filter("size = 2").select(F.col("first").alias("a"), F.col("last").alias("b")).unionByName(
        members.select(F.col("first").alias("a"), F.col("rid").alias("b")))
    pairs = stored(pairs.filter("a <> b").distinct(), "join-first-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    sets = sets_in_tiles(classes, ids, docs)
    drop_stored(classes, heads)  # the tiles are read from the same files
    g = _Graph(sets, percent)
    g.link(pairs, bounded=False)
    drop_stored(pairs)
    for low, high in ROUNDS:
        now = stored(g.label(members.select("key", "rid", "size"), "rid", "c"), "join-labelled")
        mixed = (now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.first("size").alias("size"),
                                        F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("who")).filter("lo <> hi"))
        once = mixed.groupBy("who", "size").agg(F.min("key").alias("key"))  # tiles of the same members
        share = F.pmod(F.xxhash64("key"), F.lit(ROUNDS[-1][1]))
        chosen = stored(once.filter((share >= low) & (share < high)).select("key"), "join-mixed")
        if not chosen.isEmpty():
            left = stored(now.join(chosen, "key"), "join-left")
            found = pairs_in_blocks(left, sets, percent)
            g.link(found, bounded=True)
            drop_stored(left, found)
        drop_stored(now, chosen)
    drop_stored(members, sets)
    return g.labels


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest doc_id reachable by links."""
    band_tops(percent)  # refuses a percent out of range before any job
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    shape = shapes(docs, percent)
    sets = stored(shape.filter("n > 0").groupBy("set_id").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least"),
                                                              F.count("*").alias("copies")), "join-sets")
    classes = stored(shape.select("rid", "row_key", "set_id", "tiles").join(sets.select("rid"), "rid", "left_semi"),
                     "join-classes")
    rows = stored(shape.select("doc_id", "n", "set_id"), "join-rows")
    drop_stored(shape)
    found = link_all(classes.select("rid", "row_key", "set_id"), classes.select("rid", "tiles"), docs, percent)
    if found is None:
        named = sets.filter("copies > 1").select("set_id", F.col("least").alias("component_id"))
    else:
        joined = sets.join(found.withColumnRenamed("id", "rid"), "rid", "left")
        least = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id"))
        named = (joined.join(least, "component", "left").filter("copies > 1 OR component IS NOT NULL")
                 .select("set_id", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id"))
                         .alias("component_id")))
    named = stored(named.withColumn("named", F.lit(True)), "join-components")
    return (rows.join(named, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
