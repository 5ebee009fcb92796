"""Near-duplicate documents by HyperMinHash sketches.

A document's set is its distinct shingles of five words (A-Z lower-cased; a shorter
document's whole sequence is its one shingle). Documents are linked where
100 * |intersection| >= percent * |union| (85 if not given, at least 80); the result is the
connected components.

1. Documents with the same set are one class, represented by its smallest doc_id.
2. A sketch has one register a bucket: the least hash of the shingles that fall into
   it, kept as its number of leading zeros (6 bits) and the next 10 bits (mantissa).
   Shingles are dealt to buckets by a first hash; buckets that stay empty take part
   in further rounds with other hashes, and at last every shingle may fall into
   every bucket still empty, so that two registers agree with a probability of the
   Jaccard similarity whatever the size of the sets.
3. Runs of ``rows`` registers are hashed to band keys. With 40 bands of 6 registers a
   pair at 85 percent shares no key once in 10^8; below 85, shorter bands keep that rate.
4. Members of a band are compared with the band's first one (not with each other).
   Sizes and the estimated similarity, corrected for registers that agree by chance,
   sort out candidates by six standard errors below the threshold; what is left is
   confirmed on the full sets. Links are contracted to components.
5. Bands that still hold more than one component are gone through again: their
   members are dealt to blocks, and every two blocks of a band are compared within
   one task, by size, sketch and set; only linked pairs leave it. A pair that shares
   several bands is compared in the first of them. Bands of more than ``LARGE``
   members are not compared so: their documents get longer sketches with longer
   bands, in which only more similar documents meet, and go through steps 3 to 5 with
   those; at the last level all bands are compared. No band or candidate is dropped.

Null or empty texts have an empty set: they are linked with nothing. A doc_id names one
document: rows that repeat it with another text keep their own set and class, but only
one of the texts is compared with unequal ones. Rows with a null doc_id are linked with
nothing, have a null component and are kept. Sets are held as
64-bit hashes of their shingles. Input columns other than doc_id and text are not read.

No group is gathered in one task: members reach a band's first one through joins of
two stored tables, whose hot keys adaptive execution splits, and all else is
aggregated per task before it is shuffled.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import drop_stored, map_slices, stored

WORDS = 5
PERCENT = 85
Levels = tuple[tuple[int, int], ...]
#: (registers a band, bands) of the first sketch and of those for documents in very large mixed bands.
LEVELS: Levels = ((6, 40), (12, 130), (20, 420))
LOWEST = 80
#: The same for thresholds from ``LOWEST`` up to below ``PERCENT``: a pair at 80 percent shares no key once in 10^8.
LOW_LEVELS: Levels = ((5, 50), (9, 130), (14, 420))
LARGE = 20_000  # members of a mixed band from which its documents go to the next level
ROUNDS = 8  # rounds of dealing shingles to buckets before every shingle may fill every empty bucket
MANTISSA = 10
BLOCK = 256  # members that a task compares with each other or with as many others
ERRORS = 6.0  # standard errors of the estimate that a candidate may lie below the threshold
_P = np.uint64(0x9E3779B97F4A7C15)


def levels_for(percent: int) -> Levels:
    """The bands in which pairs at the threshold meet."""
    if not LOWEST <= percent <= 100:
        raise ValueError(f"percent must be from {LOWEST} to 100, not {percent}")
    return LEVELS if percent >= PERCENT else LOW_LEVELS


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 100_000:
            self.clear()
        self[word] = h
        return h


_word_hashes = _WordHashes()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and space and 9 to 13 only
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hashes.__getitem__, w), np.uint64, len(w))
    k = min(words, len(w))
    n = len(w) - k + 1
    s = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        s = mix(s * _P + h[j:j + n])
    return np.unique(s)


def sketch(s: np.ndarray, buckets: int, seed: int = 0) -> np.ndarray:
    """The registers (16 bits each) of a non-empty set."""
    value = np.zeros(buckets, np.uint64)
    empty = np.ones(buckets, bool)
    for r in range(ROUNDS):
        h = mix(s ^ mix(np.uint64([seed * 1000 + r + 1]) * _P))
        at = ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        v = mix(h + _P)
        if r:
            on = empty[at]
            at, v = at[on], v[on]
        order = np.argsort(v)[::-1]  # the least value is written last
        value[at[order]] = v[order]
        empty[at] = False
        if not empty.any():
            break
    else:
        left = np.flatnonzero(empty)
        seeds = mix((left.astype(np.uint64) + np.uint64(seed * 100_000 + 50_000)) * _P)
        step = max(1, 1_000_000 // len(s))
        for k in range(0, len(left), step):
            value[left[k:k + step]] = mix(s[None, :] ^ seeds[k:k + step, None]).min(axis=1)
    return registers(value)


def registers(value: np.ndarray) -> np.ndarray:
    """Leading zeros (at most 48) above the ``MANTISSA`` bits that follow the first one."""
    lead = np.minimum(63 - np.floor(np.log2(np.maximum(value, np.uint64(1)).astype(np.float64))), 48).clip(0)
    lead = lead.astype(np.uint64)
    tail = (value << (lead + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((lead << np.uint64(MANTISSA)) | tail).astype(np.uint16)


def chance(n: np.ndarray, m: np.ndarray, buckets: int) -> np.ndarray:
    """Probability that the registers of unequal minima agree, for sets of n and m shingles."""
    i = np.arange(49, dtype=float)

    def lead(size: np.ndarray) -> np.ndarray:
        each = np.maximum(size / buckets, 1.0)[:, None]
        return (1 - 0.5 ** (i + 1)) ** each - (1 - 0.5 ** i) ** each

    return (lead(n) * lead(m)).sum(axis=1) / 2 ** MANTISSA


def may_link(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether pairs of sketches (rows of a and b) may reach the threshold: the estimate, corrected for
    agreement by chance, is no more than ``ERRORS`` standard errors below it."""
    buckets = a.shape[1]
    c = chance(n, m, buckets)
    estimate = ((a == b).mean(axis=1) - c) / (1 - c)
    p = percent / 100
    effective = np.minimum(buckets, np.maximum(n, m))  # registers of small sets depend on few shingles
    return estimate >= p - ERRORS * np.sqrt(p * (1 - p) / effective)


def _shapes(part: dict, buckets: int) -> dict:
    sets = [shingle_set(t) for t in part["text"]]
    return {"doc_id": part["doc_id"], "n": [len(s) for s in sets],
            "set_id": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "sketch": [sketch(s, buckets).tobytes() if len(s) else None for s in sets]}


def shapes(docs: DataFrame, levels: Levels) -> DataFrame:
    """(doc_id, n, set_id, sketch) of every row."""
    rows, bands = levels[0]
    return stored(map_slices(docs.select("doc_id", "text"), "doc_id long, n long, set_id binary, sketch binary",
                             lambda part: _shapes(part, rows * bands)), "near-shapes")


def band_keys(sketches: DataFrame, level: int, levels: Levels) -> DataFrame:
    """(band, key, id) of every band of the column ``sketch``."""
    rows, bands = levels[level]
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.struct(k.alias("band"), F.xxhash64(
        F.lit(level), k, F.substring("sketch", k * (2 * rows) + 1, F.lit(2 * rows))).alias("key")))
    return sketches.select("id", F.explode(keys).alias("k")).select("k.band", "k.key", "id")


def crowded(keys: DataFrame) -> DataFrame:
    """(band, key, id, first, size) of the bands with two members or more."""
    heads = (keys.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("size"))
             .filter("size > 1"))
    return stored(keys.join(stored(heads, "near-heads"), "key"), "near-members")


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of distinct ids that are linked, by size, sketch and at last the full sets."""
    a = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ska"))
    b = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("skb"))

    @F.pandas_udf("boolean")
    def likely(na: pd.Series, nb: pd.Series, ska: pd.Series, skb: pd.Series) -> pd.Series:
        def table(s: pd.Series) -> np.ndarray:
            return np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1)
        if not len(na):
            return pd.Series([], dtype=bool)
        return pd.Series(may_link(na.to_numpy(float), nb.to_numpy(float), table(ska), table(skb), percent))

    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    likely_pairs = stored(pairs.join(a, "a").join(b, "b").filter(fits)
                          .filter(likely("na", "nb", "ska", "skb")).select("a", "b"), "near-candidates")

    ids = likely_pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = (docs.select(F.col("doc_id").alias("id"), "text").join(stored(ids, "near-ids"), "id", "left_semi"))
    sets = stored(map_slices(texts, "id long, s binary", lambda part: {
        "id": part["id"], "s": [shingle_set(t).tobytes() for t in part["text"]]}), "near-sets")

    with_b = likely_pairs.join(sets.withColumnRenamed("id", "b").withColumnRenamed("s", "sb"), "b")
    with_both = with_b.join(sets.withColumnRenamed("id", "a").withColumnRenamed("s", "sa"), "a")
    links = stored(map_slices(with_both.select("a", "b", "sa", "sb"), "a long, b long",
                              lambda part: _linked(part, percent)).distinct(), "near-links")
    drop_stored(sets, likely_pairs)
    return links


def _linked(part: dict, percent: int) -> dict:
    """The pairs whose full sets reach the threshold."""
    out: dict = {"a": [], "b": []}
    for a, b, x, y in zip(part["a"], part["b"], part["sa"], part["sb"], strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= percent * (len(x) + len(y) - both):
            out["a"].append(a)
            out["b"].append(b)
    return out


def components(edges: DataFrame) -> DataFrame | None:
    """(id, component) of every end of ``edges`` (a, b), component the smallest id reachable; None
    without edges. Each round every node takes its smallest neighbour, chains are halved, and the
    edges are contracted, until none is left."""
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "graph-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        up = stored(least.select("id", F.least("id", "m").alias("up")), "graph-up")
        over = up.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        up = stored(up.join(over, "up").select("id", F.col("upper").alias("up")), "graph-up")
        if labels is None:
            labels = up.select("id", F.col("up").alias("component"))
        else:
            moved = up.select(F.col("id").alias("component"), "up")
            labels = stored(labels.join(moved, "component", "left")
                            .select("id", F.coalesce("up", "component").alias("component")), "graph-labels")
        ends = {c: up.select(F.col("id").alias(c), F.col("up").alias(f"up_{c}")) for c in "ab"}
        # both ends have a row in ``up``: it covers every node that still has an edge
        edges = stored(edges.join(ends["a"], "a").join(ends["b"], "b").select(
            F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b"))
            .filter("a <> b").distinct(), "graph-edges")
    return labels


class _Graph:
    """The components of the representatives found so far."""

    def __init__(self, reps: DataFrame, docs: DataFrame, percent: int):
        self.reps, self.docs, self.percent, self.labels = reps, docs, percent, None

    def label(self, df: DataFrame, id_col: str, into: str) -> DataFrame:
        """``df`` with the component of ``id_col``."""
        if self.labels is None:
            return df.withColumn(into, F.col(id_col))
        found = self.labels.select(F.col("id").alias(id_col), F.col("component").alias(into))
        return df.join(found, id_col, "left").withColumn(into, F.coalesce(into, id_col))

    def link(self, pairs: DataFrame) -> None:
        """Compare the pairs (a, b) and join the components of those that are linked."""
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .filter("a <> b").distinct(), "near-pairs")
        if pairs.isEmpty():
            return
        links = confirmed(pairs, self.reps, self.docs, self.percent)
        ends = self.label(self.label(links, "a", "ca"), "b", "cb")
        new = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        if new is None:
            return
        if self.labels is not None:
            moved = new.select(F.col("id").alias("component"), F.col("component").alias("c2"))
            old = self.labels.join(moved, "component", "left").select("id", F.coalesce("c2", "component").alias("component"))
            new = new.join(self.labels, "id", "left_anti").unionByName(old)
        self.labels = stored(new, "near-labels")


def link_all(reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the representatives that are linked to another; None if there are none."""
    g, levels = _Graph(reps, docs, percent), levels_for(percent)
    inside = reps.select("id", "sketch")
    for level in range(len(levels)):
        members = crowded(band_keys(inside, level, levels))
        g.link(members.select(F.col("first").alias("a"), F.col("id").alias("b")))
        left = mixed(g, members)
        if left is None:
            break
        last = level + 1 == len(levels)
        g.link(linked_in_blocks(left if last else left.filter(F.col("size") <= LARGE), inside, docs, levels[level][0], percent))
        if last:
            break
        ids = stored(left.filter(F.col("size") > LARGE).select("id").distinct(), "near-large")
        if ids.isEmpty():
            break
        inside = longer(docs, ids, level + 1, levels)
    return g.labels


def mixed(g: _Graph, members: DataFrame) -> DataFrame | None:
    """(band, key, id, size, c) of the bands of three members or more that hold different components."""
    now = stored(g.label(members.select("band", "key", "id", "size").filter("size > 2"), "id", "c"), "near-labelled")
    kinds = now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    left = stored(now.join(stored(kinds, "near-mixed"), "key"), "near-left")
    drop_stored(now)
    return None if left.isEmpty() else left


def linked_in_blocks(members: DataFrame, sketches: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) of the pairs of different components within a band that are linked by their sets (of 32-bit
    hashes, with a little slack: ``confirmed`` decides). Each member goes to one group for every block of
    its band, and a group holds two blocks, so no group grows with the band. ``width`` is that of a band."""
    def compare(g: pd.DataFrame) -> pd.DataFrame:
        table = np.frombuffer(b"".join(g["sketch"]), np.uint16).reshape(len(g), -1)
        block, ids, c, n = (g[x].to_numpy() for x in ("block", "id", "c", "n"))
        band = int(g["band"].iloc[0])
        sets = [np.frombuffer(x, np.uint32) for x in g["s"]]
        first = np.flatnonzero(block == block.min())
        second = first if block.min() == block.max() else np.flatnonzero(block != block.min())
        out = []
        for i in first:
            js = second[(c[second] != c[i]) & ((ids[second] > ids[i]) | (second is not first))]
            js = js[100 * np.minimum(n[i], n[js]) >= percent * np.maximum(n[i], n[js])]
            if not len(js):
                continue
            same = table[js] == table[i]
            bands = same.reshape(len(js), -1, width).all(axis=2)
            js = js[(bands.argmax(axis=1) == band) & may_link(
                np.full(len(js), n[i], float), n[js].astype(float), table[i][None], table[js], percent)]
            for j in js:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= (percent - 0.5) * (len(sets[i]) + len(sets[j]) - both):
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def small_sets(part: dict) -> dict:
        return {"id": part["id"], "s": [np.unique((shingle_set(t) >> np.uint64(32)).astype(np.uint32)).tobytes()
                                        for t in part["text"]]}

    ids = stored(members.select("id").distinct(), "near-mixed-ids")
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi")
    sets = stored(map_slices(texts, "id long, s binary", small_sets).withColumn("n", F.octet_length("s") / 4)
                  .dropDuplicates(["id"]), "near-small-sets")
    whole = members.join(sets, "id").join(sketches.select("id", "sketch"), "id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = whole.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pairs = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    return stored(pairs.select("band", "key", "lo", "hi", "block", "id", "c", "n", "sketch", "s")
                  .groupBy("key", "lo", "hi").applyInPandas(compare, "a long, b long").distinct(), "near-block-links")


def longer(docs: DataFrame, ids: DataFrame, level: int, levels: Levels) -> DataFrame:
    """(id, sketch) of the given documents with the registers of a further level."""
    rows, bands = levels[level]

    def sketches(part: dict) -> dict:
        return {"id": part["id"], "sketch": [sketch(shingle_set(t), rows * bands, level).tobytes() for t in part["text"]]}

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi")
    return stored(map_slices(texts, "id long, sketch binary", sketches).dropDuplicates(["id"]), "near-sketches")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's smallest doc_id) of every row."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shape = shapes(docs, levels_for(percent))
    usable = shape.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stored(usable.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"),
                                                  F.first("n").alias("n"), F.first("sketch").alias("sketch")),
                     "near-classes")
    found = link_all(classes.select("id", "n", "sketch"), docs, percent)
    component = classes.select("set_id", "id", "last")
    if found is not None:
        component = component.join(found, "id", "left")
    else:
        component = component.withColumn("component", F.lit(None).cast("long"))
    named = stored(component.filter((F.col("last") != F.col("id")) | F.col("component").isNotNull())
                   .select("set_id", F.coalesce("component", "id").alias("component")), "near-components")
    out = (shape.select("doc_id", "n", "set_id").join(named, "set_id", "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
