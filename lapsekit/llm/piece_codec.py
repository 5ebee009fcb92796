"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces and scores of a vocabulary file define the best segmentation: that of the
highest sum of scores (on ties, the longer piece that ends at a place). Characters
that no piece covers fall back to their UTF-8 bytes. The search reads a text once
and keeps a window no longer than the longest piece plus the undecided rest: as soon
as the backpointer paths of all places that can still be extended meet in one
boundary, the pieces before it are final and are committed.

A space always starts a new stretch for vocabularies in which no piece holds a space
mark after another character (checked on loading): there all paths meet, and what
stands between two such boundaries is looked up in a bounded memory of stretches
already searched. Where the check fails, the search runs over the whole text.

Null text gives null ids; empty text gives no ids. Decoding returns the text exactly
as it was for every text whose spaces are plain (a space mark U+2581 in the source is
read as a space, as the format has it).
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
MEMORY = 300_000  # stretches in each of the two generations that a worker remembers
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces, scores and byte ids of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.texts: list[bytes] = [b""] * n
        self.pieces: dict[str, tuple[float, int]] = {}
        self.byte_ids = [-1] * 256
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.texts[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[p] = (sp.get_score(i), i)
                self.texts[i] = p.replace(MARK, " ").encode("utf-8")
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        self.table = {p: self.pieces.get(p) for p in self.prefixes}
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for s, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.spaces_split = not any(a != MARK and b == MARK for p in self.pieces for a, b in zip(p, p[1:], strict=False))

    def viterbi(self, text: str) -> Iterator[list[int]]:
        """The ids of the best segmentation, yielded stretch by stretch as they become final."""
        pieces, prefixes, longest = self.pieces, self.prefixes, self.longest
        n = len(text)
        if n <= longest:
            yield self.within(text)
            return
        score = {0: 0.0}  # of the best path to each place in the window
        back: dict[int, tuple[int, int]] = {}  # place -> (place before, piece id; -1 for bytes)
        done = 0
        for i in range(n):
            base = score[i]
            single = False
            for k in range(i + 1, min(n, i + longest) + 1):
                part = text[i:k]
                if part not in prefixes:
                    break
                hit = pieces.get(part)
                if hit is not None:
                    single |= k == i + 1
                    s = base + hit[0]
                    if k not in score or s > score[k]:
                        score[k], back[k] = s, (i, hit[1])
            if not single:
                s = base + self.unknown
                if i + 1 not in score or s > score[i + 1]:
                    score[i + 1], back[i + 1] = s, (i, -1)
            if i - done >= longest:  # do the paths to all places still in reach meet?
                ends = {k for k in range(i + 1, min(n, i + longest) + 1) if k in back}
                while len(ends) > 1:
                    top = max(ends)
                    ends.remove(top)
                    ends.add(back[top][0])
                meet = ends.pop()
                if meet > done:
                    yield self._trace(text, back, done, meet)
                    base = score[meet]
                    for k in range(done, meet):
                        score.pop(k, None)
                        back.pop(k, None)
                    for k in score:
                        score[k] -= base
                    back.pop(meet, None)
                    done = meet
            score.pop(i - longest, None)
        if n > done:
            yield self._trace(text, back, done, n)

    def within(self, text: str) -> list[int]:
        """The same search for a text that fits into one window."""
        look = self.table.get
        n = len(text)
        score = [0.0] + [float("-inf")] * n
        back: dict[int, tuple[int, int]] = {}
        for i in range(n):
            base = score[i]
            single = False
            for k in range(i + 1, n + 1):
                hit = look(text[i:k], False)
                if hit is None:
                    continue  # the start of longer pieces only
                if hit is False:
                    break
                if k == i + 1:
                    single = True
                s = base + hit[0]
                if s > score[k]:
                    score[k], back[k] = s, (i, hit[1])
            if not single and base + self.unknown > score[i + 1]:
                score[i + 1], back[i + 1] = base + self.unknown, (i, -1)
        return self._trace(text, back, 0, n)

    def _trace(self, text: str, back: dict[int, tuple[int, int]], start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            before, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[before:end].encode("utf-8", "surrogatepass")))
            end = before
        return out[::-1]


class Memory(dict):
    """Stretch -> its ids as little-endian 32-bit integers. Two generations: when this one is full
    it becomes the older one, from which stretches in use come back, so that it stays bounded."""

    def __init__(self, search, most: int = MEMORY):
        super().__init__()
        self.search, self.most, self.older = search, most, {}

    def __missing__(self, stretch: str) -> bytes:
        out = self.older.get(stretch)
        if out is None:
            out = self.search(stretch)
        if len(stretch) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[stretch] = out
        return out


STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Codec:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.memory = Memory(self._marked)

    def _search(self, stretch: str) -> bytes:
        v = self.vocabulary
        ids = v.within(stretch) if len(stretch) <= v.longest else [i for part in v.viterbi(stretch) for i in part]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _marked(self, word: str) -> bytes:
        return self._search(MARK + word)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.vocabulary.spaces_split:
            return self._search(MARK + text.replace(" ", MARK))
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return b"".join(map(self.memory.__getitem__, text.split(" ")))
        return b"".join([self.memory[x[1:]] if x[0] == MARK and MARK not in x[1:] else self._search(x)
                         for x in STRETCH.findall(MARK + text.replace(" ", MARK))])

    def decode(self, ids: bytes) -> str:
        texts = self.vocabulary.texts
        out = b"".join(map(texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out.decode("utf-8", "replace")[1:]  # the first character is the mark put before every text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


SLICE = 256  # rows that a worker holds results of at once


def _with(df: DataFrame, column: str, into: str, kind: T.DataType, convert) -> DataFrame:
    """``df`` with the column ``into`` (replacing one of that name): ``convert`` makes the function of a
    worker from one value to another. Results leave in small slices, whatever the size of a batch."""
    kept = [f for f in df.schema.fields if f.name != into or f.name == column]
    schema = T.StructType([*[f for f in kept if f.name != into], T.StructField(into, kind)])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = convert()
        arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                values = part.column(part.schema.get_field_index(column)).to_pylist()
                made = pa.array([None if v is None else one(v) for v in values], arrow)
                yield pa.RecordBatch.from_arrays(
                    [made if n == into else part.column(part.schema.get_field_index(n)) for n in names], names)

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as binary (little-endian 32-bit integers)."""
    return _with(df, text, into, T.BinaryType(), lambda: codec(path).encode)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``df`` with the text of binary ids."""
    return _with(df, ids, into, T.StringType(), lambda: codec(path).decode)
