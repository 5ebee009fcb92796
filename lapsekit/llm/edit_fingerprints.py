"""Document fingerprints by randomised edit embedding.

All documents share one random walk: at step j the walk emits the symbol at its place
and moves on by a bit h_j(symbol) that is the same for every text, so that after an
insertion or deletion two walks fall into step again and the number of unequal steps
follows the edit distance. Symbols are hashes of four consecutive characters. Places
of the embedding are sampled by a hash of the step (bit sampling): the ``SAMPLES``
steps of lowest hash within the walk's expected length. The rule does not depend on
the text, so texts of different length share the sampled steps of the shorter range.

A fingerprint is the number of characters and two hex digits for each sampled step
(``--`` past the end). The likeness of two is the share of the longer text's sampled
steps at which both have the same symbol. ``bands`` cuts the sampled steps into bands
for a candidate join, and ``edit_distance_within`` holds candidates against the true edit distance.

Null text counts as empty; empty texts all have the fingerprint ``0:`` and likeness 1
to each other, 0 to others. Whole texts are walked, whatever their length: documents
run side by side in vectors, and the few that outlast the others go on alone.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import frame

SAMPLES = 128
GRAM = 4
LANES = 48  # fewer walks than this at once go on in plain Python
BATCH_CHARS = 8_000_000  # walked side by side
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.random.Generator(np.random.PCG64(2024)).integers(0, 2, 1 << 16, dtype=np.uint8)
_SHIFT = np.random.Generator(np.random.PCG64(2025)).integers(0, 1 << 16, 1 << 16, dtype=np.int64)
_BITS_LIST, _SHIFT_LIST = _BITS.tolist(), _SHIFT.tolist()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def symbols(text: str) -> np.ndarray:
    """A 16-bit hash of each run of ``GRAM`` characters (the last ones are filled up), in order."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(c)
    padded = np.concatenate([c, np.zeros(GRAM - 1, np.uint32)])
    h = c * np.uint32(0x01000193)
    for k in range(1, GRAM):
        h = (h ^ padded[k:k + n]) * np.uint32(0x01000193)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (h >> np.uint32(16)).astype(np.int32)


class _Steps:
    """The sampled steps of a walk over n characters: the lowest hashes in [0, 2 n)."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # range covered, steps, hashes
        self.memory: dict[int, np.ndarray] = {}

    def _level(self, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Steps of hash below 2^(64-k), as far as 2^(k+9)."""
        while len(self.levels) <= k:
            i = len(self.levels)
            reach = 1 << (i + 9)
            if i == 0:
                steps = np.arange(reach, dtype=np.uint64)
                hashes = _mixed((steps + np.uint64(1)) * _MIX)
            else:
                _, old, old_h = self.levels[i - 1]
                steps = np.arange(reach // 2, reach, dtype=np.uint64)
                hashes = _mixed((steps + np.uint64(1)) * _MIX)
                steps, hashes = np.concatenate([old, steps]), np.concatenate([old_h, hashes])
                low = hashes < np.uint64(1 << (64 - i))
                steps, hashes = steps[low], hashes[low]
            self.levels.append((reach, steps, hashes))
        return self.levels[k]

    def __call__(self, n: int) -> np.ndarray:
        """Sorted."""
        found = self.memory.get(n)
        if found is None:
            k = max(0, (2 * n - 1).bit_length() - 9)
            _, steps, hashes = self._level(k)
            end = int(np.searchsorted(steps, 2 * n))
            chosen = np.argsort(hashes[:end], kind="stable")[:SAMPLES]
            found = np.sort(steps[:end][chosen]).astype(np.int64)
            if len(self.memory) > 50_000:
                self.memory.clear()
            self.memory[n] = found
        return found


sampled_steps = _Steps()


def walk_all(texts: list[str]) -> list[str]:
    """The fingerprints of ``texts``."""
    out = [""] * len(texts)
    syms = [symbols(t) for t in texts]
    order = sorted((k for k in range(len(texts)) if texts[k]), key=lambda k: -len(texts[k]))
    at = 0
    while at < len(order):  # lanes of similar length
        lane, chars = [], 0
        while at < len(order) and (not lane or chars + len(syms[order[at]]) <= BATCH_CHARS):
            lane.append(order[at])
            chars += len(syms[order[at]])
            at += 1
        for k, picked in zip(lane, _lanes([syms[k] for k in lane]), strict=True):
            out[k] = _format(len(syms[k]), picked)
    return [x or "0:" for x in out]


def _format(n: int, picked: np.ndarray) -> str:
    hexes = (picked & 255).astype(np.uint8).tobytes().hex()
    ends = np.flatnonzero(picked < 0)  # a walk that has ended does not go on
    body = hexes if not len(ends) else hexes[:2 * int(ends[0])] + "--" * (len(picked) - int(ends[0]))
    return f"{n}:{body}"


PAD = 16  # steps between two looks at which walks have ended; each text has as many blank symbols behind it


def _lanes(syms: list[np.ndarray]) -> list[np.ndarray]:
    """Symbols at the sampled steps (-1 past the end) of each, given in falling length."""
    lengths = np.array([len(s) for s in syms], np.int64)
    wanted = [sampled_steps(int(n)) for n in lengths]
    picked = [np.full(len(w), -1, np.int32) for w in wanted]
    blank = np.full(PAD + 1, -1, np.int32)
    starts = np.concatenate([[0], np.cumsum(lengths + PAD + 1)[:-1]])
    ends = starts + lengths
    live, place, j = np.arange(len(syms)), starts.copy(), 0
    if len(live) >= LANES:
        data = np.concatenate([x for s in syms for x in (s, blank)])
        need = np.unique(np.concatenate(wanted)).tolist()
        table = np.full((len(need), len(syms)), -1, np.int32)
        row = 0
        while len(live) >= LANES:
            for j in range(j, j + PAD):  # noqa: B020
                sym = data[place]
                if row < len(need) and need[row] == j:
                    table[row, live] = sym
                    row += 1
                place = place + _BITS[(sym + _SHIFT_LIST[j & 0xFFFF]) & 0xFFFF]
            j += 1
            on = place < ends[live]
            if not on.all():
                live, place = live[on], place[on]
        rows = np.array(need)
        for k in range(len(syms)):
            picked[k][:] = table[np.searchsorted(rows, wanted[k]), k]
    for k, p in zip(live.tolist(), place.tolist(), strict=True):
        _alone(syms[k][p - int(starts[k]):].tolist(), j, wanted[k], picked[k])
    return picked


def _alone(sym: list[int], j: int, wanted: np.ndarray, picked: np.ndarray) -> None:
    """Go on with one walk from step j; ``sym`` are the symbols from its place on."""
    bits, shift, n, p = _BITS_LIST, _SHIFT_LIST, len(sym), 0
    for i in range(bisect.bisect_left(wanted, j), len(wanted)):
        until = int(wanted[i])
        while j < until and p < n:
            p += bits[(sym[p] + shift[j & 0xFFFF]) & 0xFFFF]
            j += 1
        if p >= n:
            return
        picked[i] = sym[p]


def parse(fingerprint: str) -> tuple[int, str]:
    n, _, body = fingerprint.partition(":")
    return int(n), body


def likeness(a: str, b: str) -> float:
    """From 0 to 1: the share of the longer text's sampled steps with the same symbol in both."""
    (n, x), (m, y) = parse(a), parse(b)
    if n == 0 or m == 0:
        return float(n == m)
    if n < m:
        (n, x), (m, y) = (m, y), (n, x)
    long, short = sampled_steps(n), sampled_steps(m)
    at = np.searchsorted(short, long)
    shared = (at < len(short)) & (short[np.minimum(at, len(short) - 1)] == long)
    vx = np.frombuffer(x.encode(), "<u2")
    vy = np.frombuffer(y.encode(), "<u2")
    blank = int.from_bytes(b"--", "little")
    px, py = vx[shared], vy[at[shared]]
    both = int(((px == blank) & (py == blank)).sum())
    total = len(long) - both
    return float((px == py).sum() - both) / total if total else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first as many characters of the next text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int | None = None) -> DataFrame:
    """The documents by falling doc_id, dealt to ranges of ids, one a partition and sorted; ``follows``
    marks the row behind a range's last one: the first row of the next range (after the last, of the first).

    Equal ids follow each other by text hash and text, null ids come last. The borders are
    quantiles of the ids; the driver holds borders and one (id, hash) a range, nothing else.
    """
    spark = docs.sparkSession
    d = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
         .withColumn("h", F.xxhash64("text")))
    n = n or max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [int(c) for c in sorted(set(d.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)))]
    above = F.size(F.filter(F.lit(cuts), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    d = d.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above))
    heads = (d.groupBy("range").agg(F.max(F.struct("doc_id", F.bitwise_not("h").alias("h"))).alias("head"))
             .orderBy("range").collect())
    size = len(cuts) + 2
    ids, hashes, before = [None] * size, [None] * size, [None] * size
    for k, r in enumerate(heads):
        ids[r["range"]], hashes[r["range"]] = r["head"]["doc_id"], ~r["head"]["h"]
        before[r["range"]] = heads[k - 1]["range"]  # the first range's rows also stand behind the last one

    def of_range(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("range"))

    here = F.struct("range", F.lit(False).alias("follows"))
    there = F.struct(of_range(before, "int").alias("range"), F.lit(True).alias("follows"))
    first = (F.col("h") == of_range(hashes, "long")) & F.col("doc_id").eqNullSafe(of_range(ids, "long"))
    return (d.withColumn("c", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))))
            .select("c.range", "c.follows", "doc_id", "h", "text").repartitionById(size, "range")
            .sortWithinPartitions("range", "follows", F.desc_nulls_last("doc_id"), "h", "text"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: fingerprint, that of its edited text, and the likeness of its fingerprint to the
    edited text's and to the next document's."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None  # the row whose next one is still to come: (id, text, fingerprint)
        here = None
        for b in batches:
            out: list[tuple] = []
            for part, follows, ids, texts in _runs(b):
                if part != here:
                    here, last = part, None
                if follows:
                    if last is not None:
                        out += _rows([last, (None, texts[0], walk_all(texts[:1])[0])])
                        last = None
                    continue
                rows = ([last] if last is not None else []) + list(zip(ids, texts, walk_all(texts), strict=True))
                out += _rows(rows)
                last = rows[-1]
            yield frame(out, names, ("doc_id",))

    # ids as decimals, so that a null does not turn its batch into floating point
    dealt = ranges(docs, doc_id, text).select("range", "follows", F.col("doc_id").cast("decimal(20,0)"), "text")
    return dealt.mapInPandas(run, SCHEMA)


def _runs(b: pd.DataFrame) -> Iterator[tuple[int, bool, list, list[str]]]:
    """The rows of a batch cut where range or follows changes, in pieces of bounded text."""
    parts, follows, texts = b["range"].tolist(), b["follows"].tolist(), b["text"].tolist()
    ids = [None if pd.isna(x) else int(x) for x in b["doc_id"]]
    start, chars = 0, 0
    for k in range(len(parts) + 1):
        if k == len(parts) or k > start and ((parts[k], follows[k]) != (parts[start], follows[start])
                                             or chars > 2 * BATCH_CHARS):
            if k > start:
                yield parts[start], follows[start], ids[start:k], texts[start:k]
            start, chars = k, 0
        if k < len(parts):
            chars += len(texts[k])


def _rows(rows: list[tuple]) -> list[tuple]:
    """The result rows of all but the last of ``rows``, which are neighbours."""
    changed = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)]
    out = []
    for (d, t, f), (_, _, following), e, fe in zip(rows, rows[1:], changed, walk_all(changed), strict=False):
        out.append((d, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), f, fe,
                    likeness(f, fe), likeness(f, following)))
    return out


BANDS, BAND_STEPS = 24, 4


def bands(found: DataFrame, n_bands: int = BANDS, steps: int = BAND_STEPS) -> DataFrame:
    """(doc_id, band): keys of ``steps`` sampled symbols each, equal where two texts of about the same
    length agree there. Bands past the end of a text give no key; exact copies share all keys."""
    body = F.substring_index("fingerprint", ":", -1)
    keys = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda k: F.struct(
        k.alias("band"), F.substring(body, k * (2 * steps) + 1, F.lit(2 * steps)).alias("key")))
    cut = found.select("doc_id", F.explode(keys).alias("k"))
    return cut.filter((F.length("k.key") == 2 * steps) & ~F.col("k.key").contains("-")).select(
        "doc_id", F.concat_ws(":", F.col("k.band"), F.col("k.key")).alias("band"))


def edit_distance_within(a: str, b: str, most: int) -> int | None:
    """The edit distance of two texts where it is at most ``most``, else None (diagonals only)."""
    if abs(len(a) - len(b)) > most:
        return None
    reach = {0: 0}  # diagonal -> furthest place in a, for the edits so far
    for edits in range(most + 1):
        for d, i in list(reach.items()):
            while i < len(a) and i + d < len(b) and a[i] == b[i + d]:
                i += 1
            reach[d] = i
            if i == len(a) and i + d == len(b):
                return edits
        new: dict[int, int] = {}
        for d, i in reach.items():
            for nd, ni in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):
                if ni <= len(a) and ni + nd <= len(b):
                    new[nd] = max(new.get(nd, -1), ni)
        reach = new
    return None
