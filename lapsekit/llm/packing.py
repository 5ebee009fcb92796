"""Packing of documents into sequences of a fixed number of tokens, by length patterns.

Only the histogram of piece lengths (at most ``MAX_TOKENS`` entries, whatever the
corpus) reaches the driver. There, patterns of a few lengths that fill a sequence
are enumerated over length classes (the shortest pieces are in none: they fill gaps best), non-negative least squares fits how often each
should repeat so that the classes are used up, the counts are rounded down, and
filled with the real lengths so that they fill the sequence exactly, or, where no such
lengths are left, but for a small gap. What is left (the residual, by rounding or for
want of a partner) is packed by best-fit decreasing, into the gaps of the patterns
first. Where that misses the lower bound, smaller shares of the fitted repeats are
tried too, down to none, so a plan never has more sequences than best fit alone. All steps
work on (length, count) pairs, so their cost depends on the number of lengths and not
on the corpus.

The plan is a list of groups of equal sequences, each a tuple of lengths and a
repeat count. Every piece has a rank among the pieces of its length (its task's
offset plus its place in the task), and the plan's ranges of ranks give sequence and
offset: no document is gathered, sorted or joined to others.

A document's tokens are those of the byte-level vocabulary without special tokens
(their strings are ordinary text), then the id 0. Only documents longer than
``MAX_TOKENS`` are cut, into whole sequences' lengths from the end; the first piece
takes the rest. Null and empty texts are the single id 0. Repeated rows are packed
one by one; an empty table gives no sequence.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lapsekit.llm.common import SLICE, stored
from lapsekit.llm.piece_codec import Memory

MAX_TOKENS = 2048
END = b"\x00\x00\x00\x00"  # the id 0 after each document
CLASSES = 64  # length classes of the patterns
PATTERN_DOCS = 4
LEAST_CLASS = 4  # patterns have no smaller class: the shortest pieces fill what the others leave
MAX_GAP = 32  # tokens that a filled pattern may leave open, for the residual; pieces without so close a fit go there
SHARES = (1.0, 0.8, 0.5, 0.0)  # of the fitted repeats; the rest is residual

# A plain space that stands between two characters that are not white space always starts a new word of the
# vocabulary's own splitter, and the word takes the space along. So texts are split there, and a word with its
# space is looked up. Texts with other runs of white space are first cut where that splitter cuts such runs.
_WHITE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
WORDS_KEPT = 250_000  # words in each of the two generations that a worker remembers
MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a word of the splitter with letters behind it
PART = re.compile(f"[{_WHITE}]+(?![^{_WHITE}])| ?[^{_WHITE}]+|[{_WHITE}]+")


class _Run(Exception):
    """A space beside other white space."""


def _byte_letters() -> dict[int, str]:
    """The byte-level vocabulary's letter for each byte: itself where it prints, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b if b in prints else 256 + others.index(b)) for b in range(256)}


LETTERS = _byte_letters()


class Tokens:
    """Ids of a text as little-endian 32-bit integers, with a bounded memory of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.memory = Memory(self._spaced, WORDS_KEPT)
        self.starts = Memory(self._bare, 50_000)  # words that no space precedes

    def _plain(self, part: str) -> bytes:
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _letters(self, word: str) -> bytes:
        """Letters alone are one word of the splitter: straight to the merges."""
        ids = [t.id for t in self.model.tokenize(word.encode("utf-8").decode("latin-1").translate(LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _spaced(self, word: str) -> bytes:
        """The ids of a space and the word."""
        if word.isalpha():
            return self._letters(" " + word)
        if not word or word[0] in _WHITE or word[-1] in _WHITE:
            raise _Run
        head, line, tail = word.partition("\n")
        if line and tail[0] not in _WHITE and head[-1] not in _WHITE:  # a single line end is a word of its own
            return self.memory[head] + self.starts[line] + self.starts[tail]
        if (head := word.rstrip(MARKS)).isalpha():  # and so are marks behind letters
            return self.memory[head] + self.starts[word[len(head):]]
        return self._plain(" " + word)

    def _bare(self, word: str) -> bytes:
        if word.isalpha():
            return self._letters(word)
        if (head := word.rstrip(MARKS)).isalpha():
            return self.starts[head] + self.starts[word[len(head):]]
        return self._plain(word)

    def encode(self, text: str) -> bytes:
        if "  " not in text:
            first, *rest = text.split(" ")
            try:
                return self._plain(first) + b"".join(map(self.memory.__getitem__, rest))
            except _Run:
                pass
        return b"".join([self.memory[x[1:]] if x[0] == " " and x[-1] not in _WHITE else self._plain(x)
                         for x in PART.findall(text)])


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
           max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, [ids,] task, place): ``place`` counts the pieces of one
    length within one task. Written out, so that the places stay as they are."""
    key = docs.schema[doc_id].dataType.simpleString()
    schema = (f"doc_id {key}, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids
              + "task int, place long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(tokenizer)
        seen: Counter[int] = Counter()
        task = TaskContext.get().partitionId()
        for part in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            rows = []
            for d, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = (t.encode(x) if x else b"") + END
                n = len(ids) // 4
                size = n if n <= max_tokens else n % max_tokens or max_tokens
                start = piece = 0
                while start < n:
                    own = ids[4 * start:4 * (start + size)]
                    rows.append((d, piece, start, size, zlib.crc32(own), *([own] if with_ids else ()), task, seen[size]))
                    seen[size] += 1
                    start, piece, size = start + size, piece + 1, max_tokens
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)],
                                             schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(cut, schema), "pieces")


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method of Lawson and Hanson."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[free] = -np.inf
        if (j := int(np.argmax(w))) < 0 or w[j] <= 1e-9 * scale:
            break
        free[j] = True
        while True:
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if s[free].min() > 0:
                break
            low = free & (s <= 0)
            step = np.min(x[low] / (x[low] - s[low]))
            x = x + step * (s - x)
            free &= x > 1e-12 * scale
            x[~free] = 0
            if not free.any():
                s = x
                break
        x = s
    return x


def class_patterns(classes: int = CLASSES, most: int = PATTERN_DOCS) -> list[tuple[int, ...]]:
    """Tuples of at most ``most`` classes, largest first, that add up to a whole sequence (``classes``)."""
    def grow(left: int, top: int, slots: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif slots:
            for c in range(min(left, top), -(-left // slots) - 1, -1):
                for rest in grow(left - c, c, slots - 1):
                    yield (c, *rest)
    return list(grow(classes, classes, most))


class _Filler:
    """Takes real lengths from the counts for patterns of classes."""

    def __init__(self, counts: np.ndarray, max_tokens: int, classes: int):
        self.counts, self.max_tokens, self.unit = counts, max_tokens, max_tokens / classes

    def of(self, c: int) -> np.ndarray:
        """The lengths of a class that are left, the most frequent first."""
        low, high = (round((c + d) * self.unit) for d in (-0.5, 0.5))
        k = np.arange(max(1, low + 1), min(high, self.max_tokens - 1) + 1)
        k = k[self.counts[k] > 0]
        return k[np.argsort(-self.counts[k], kind="stable")]

    def lengths(self, pattern: tuple[int, ...], gap: int) -> tuple[int, ...]:
        """Lengths for the pattern that leave at most ``gap`` tokens open; empty if there are none. The last
        slot takes what the others leave, the others stay in their classes."""
        if len(pattern) == 1:
            return next(((int(k),) for k in self.of(pattern[0]) if self.max_tokens - gap <= k <= self.max_tokens), ())
        fixed: list[int] = []
        for c in pattern[:-3]:
            if not len(left := self.of(c)):
                return ()
            fixed.append(int(left[0]))
            self.counts[fixed[-1]] -= 1
        try:
            turns = [[int(k)] for k in self.of(pattern[-3])] if len(pattern) > 2 else [[]]
            for turn in turns:
                for k in turn:
                    self.counts[k] -= 1
                x = self.of(pattern[-2])
                room = self.max_tokens - sum(fixed) - sum(turn)
                for g in range(gap + 1):
                    y = room - g - x
                    ok = y > 0
                    has = np.where(ok, np.minimum(self.counts[x], self.counts[np.where(ok, y, 0)] - (x == y)), 0)
                    if len(has) and has.max() > 0:
                        j = int(has.argmax())
                        found = (*fixed, *turn, int(x[j]), int(y[j]))
                        break
                else:
                    found = ()
                for k in turn:
                    self.counts[k] += 1
                if found:
                    return found
            return ()
        finally:
            for k in fixed:
                self.counts[k] += 1

    def fill(self, pattern: tuple[int, ...], n: int, gap: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Groups of ``n`` repeats, or of as many as the lengths allow."""
        while n > 0 and (lengths := self.lengths(pattern, gap)):
            used = Counter(lengths)
            m = int(min(n, *(self.counts[k] // u for k, u in used.items())))
            for k, u in used.items():
                self.counts[k] -= m * u
            n -= m
            yield lengths, m


def fit_repeats(counts: np.ndarray, patterns: list[tuple[int, ...]], classes: int) -> np.ndarray:
    """How often each pattern should repeat (not rounded), for the counts by length."""
    per_class = np.zeros(classes + 1)
    unit = (len(counts) - 1) / classes
    np.add.at(per_class, np.ceil(np.arange(len(counts)) / unit - 0.5).astype(int).clip(0), counts)
    a = np.zeros((classes, len(patterns)))
    for j, p in enumerate(patterns):
        for c in p:
            a[c - 1, j] += 1
    present = np.array([all(per_class[c] for c in p) for p in patterns])
    out = np.zeros(len(patterns))
    if present.any():
        out[present] = nnls(a[:, present], per_class[1:])
    return out


def plan_patterns(histogram: dict[int, int], max_tokens: int = MAX_TOKENS, classes: int = CLASSES,
                  most: int = PATTERN_DOCS) -> list[tuple[tuple[int, ...], int]]:
    """Groups (lengths, repeat count) that use every piece of the histogram exactly once. Of ``SHARES`` of the
    fitted repeats the plan with the fewest sequences is taken (the first of these)."""
    whole = [((max_tokens,), histogram[max_tokens])] if histogram.get(max_tokens) else []
    counts = np.zeros(max_tokens + 1, np.int64)
    for k, v in histogram.items():
        if k < max_tokens:
            counts[k] = v
    if not counts.any():
        return whole
    least = -(-int(counts @ np.arange(max_tokens + 1)) // max_tokens)
    patterns = [p for p in class_patterns(classes, most) if min(p) >= LEAST_CLASS]
    repeats = fit_repeats(counts, patterns, classes)
    order = np.argsort([-max(p) for p in patterns], kind="stable")
    best: list[tuple[tuple[int, ...], int]] = []
    fewest = None
    for share in SHARES:
        filler, groups = _Filler(counts.copy(), max_tokens, classes), []
        open_ = np.floor(repeats * share).astype(np.int64)
        for gap in (0, MAX_GAP):  # exact fits of all patterns first
            for j in order[open_[order] > 0]:
                for lengths, m in filler.fill(patterns[j], int(open_[j]), gap):
                    groups.append((lengths, m))
                    open_[j] -= m
        plan = _best_fit({int(k): int(filler.counts[k]) for k in np.flatnonzero(filler.counts)}, groups, max_tokens)
        n = sum(m for _, m in plan)
        if fewest is None or n < fewest:
            best, fewest = plan, n
        if fewest == least:
            break
    return whole + best


def _best_fit(left: dict[int, int], groups: list[tuple[tuple[int, ...], int]],
              max_tokens: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of the lengths left, into the gaps of ``groups`` and new sequences."""
    by_gap: dict[int, list[list]] = {}

    def put(lengths: tuple[int, ...], n: int) -> None:
        by_gap.setdefault(max_tokens - sum(lengths), []).append([lengths, n])

    for lengths, n in groups:
        put(lengths, n)
    for k in sorted(left, reverse=True):
        n = left[k]
        while n:
            gap = min((g for g, have in by_gap.items() if g >= k and have), default=None)
            if gap is None:
                each = max_tokens // k  # new sequences, each filled with this length
                if n >= each:
                    put((k,) * each, n // each)
                    n %= each
                else:
                    put((k,) * n, 1)
                    n = 0
                continue
            lengths, have = by_gap[gap].pop()
            m = min(n, have)
            if have > m:
                by_gap[gap].append([lengths, have - m])
            put((*lengths, k), m)
            n -= m
    return [(lengths, n) for have in by_gap.values() for lengths, n in have]


def ranges(groups: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each (length, first rank): the first sequence and the offset of that range of ranks, in order."""
    seen: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, n in groups:
        offset = 0
        for k in lengths:
            rows.append((k, seen[k], sequence, offset))
            seen[k] += n
            offset += k
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def assign(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The pieces with sequence_id and offset, without task and place."""
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(ranges(plan_patterns(histogram, max_tokens)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = table.value
        k = np.searchsorted(t["key"], (length.to_numpy(np.int64) << 44) + rank.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence_id": t["sequence"][k] + rank.to_numpy(np.int64) - t["rank"][k],
                             "offset": t["offset"][k]})

    ranks = counts.select("length", "task", before.alias("before"))  # grows with the tasks, so it is not broadcast
    ranked = pieces.join(ranks.hint("shuffle_hash"), ["length", "task"])
    found = ranked.withColumn("__at", find(F.col("length"), F.col("before") + F.col("place")))
    kept = [c for c in pieces.columns if c not in ("task", "place")]
    return found.select(*kept, "__at.sequence_id", "__at.offset")


def pack(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    return assign(pieces(docs, tokenizer, **options), options.get("max_tokens", MAX_TOKENS))
