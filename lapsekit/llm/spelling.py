"""Spelling variants: words one edit apart, by composition of finite-state machines.

The vocabulary acceptor, composed with a transducer that copies its input but for exactly
one inserted, deleted or replaced code point, and with the acceptor again, accepts the pairs
of words one edit apart. It is built and enumerated in parts:

1. Words are counted by task and added up by Spark: one row a word.
2. An initial state of the composition is a prefix of ``PREFIX`` code points read by both
   acceptors before any edit. Each prefix is a partition of its own, with the minimised
   acceptor (states with equal endings merged) of the words that start so. Prefixes that
   more than ``LIMIT`` words share are followed by one code point more, until none does.
3. Inside a partition both acceptors are in one state up to the edit. There the transducer
   leaves the copying state: by two different arcs (replaced) or by one arc against none
   (inserted, deleted). From then on it copies, so the rest is an intersection of two
   states' endings. What a pair of states, and what a state accepts after an edit is kept
   (as ranks of words, not as strings) and used again wherever these states come back.
4. Pairs whose edit lies within the prefix go through different initial states; after the
   edit only equal rests are accepted, so these meet in a join on the word without that
   code point. Such a group has one word for each code point of the alphabet at most.
5. A pair is taken where its words first differ, hence exactly once; partitions return
   one row a word (number of near words, its best one), and Spark adds them up.
6. Forms are followed to the last by doubling; their counts grow fivefold a step.

Null texts have no words. A null doc_id stands as ``null`` in the hashed string. Repeated
rows count again. An empty table, or one without frequent words, gives no row. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import drop_stored, stored

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent as its variant
CHANGE = 199  # one of so many (document, word) pairs loses a code point
PREFIX = 3  # code points of the first initial states; less than MIN_LENGTH
LIMIT = 20_000  # words of a partition
WORDS_HELD = 200_000  # different words that a counting task holds before it hands them on
_RUN = re.compile("[a-zÀ-ÿ]+")


# ---- 1. words ---------------------------------------------------------------------------
def variant(doc: str, word: str) -> str:
    """The word as it counts: in one of ``CHANGE`` cases without one of its code points."""
    h = zlib.crc32(word.encode(), zlib.crc32(f"{doc}:".encode()))
    if h % CHANGE:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        held: Counter[str] = Counter()
        for b in batches:
            for doc, value in zip(b["doc"], b["text"], strict=True):
                # bytes.lower() changes A-Z only
                own = Counter(_RUN.findall((value.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                for word, n in own.items():
                    if len(word) >= MIN_LENGTH and len(word := variant(doc.as_py(), word)) >= MIN_LENGTH:
                        held[word] += n
                if len(held) > WORDS_HELD:
                    yield rows()
                    held.clear()
        yield rows()

    cols = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc"), F.col(text).alias("text"))
    counts = cols.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= MIN_COUNT)


# ---- 2. and 3. acceptor and composition --------------------------------------------------
class Acceptor:
    """The minimised acceptor of sorted distinct words. States are numbered so that arcs lead to smaller
    numbers; ``arcs[q]`` is {code point: state}, in order; ``size[q]`` the number of endings of q, and
    ``first[q]`` {code point: rank of the first ending by that arc} (the empty ending is rank 0)."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        self.first: list[dict[str, int]] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, {}, None]]  # of the last word: [final, finished arcs, arc to the next]
        last = ""

        def close(depth: int) -> None:
            """Finish the states of the last word below ``depth``."""
            while len(path) > depth + 1:
                final, arcs, _ = path.pop()
                path[-1][1][path[-1][2]] = self._state(known, final, arcs)

        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            close(same)
            for c in word[same:]:
                path[-1][2] = c
                path.append([False, {}, None])
            path[-1][0] = True
            last = word
        close(0)
        self.root = self._state(known, *path[0][:2])

    def _state(self, known: dict, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        if key not in known:
            known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
            first, n = {}, int(final)
            for c, r in arcs.items():
                first[c] = n
                n += self.size[r]
            self.first.append(first)
            self.size.append(n)
        return known[key]


_NONE = np.empty((0, 2), np.int64)


class Composition:
    """Acceptor, one-edit transducer, acceptor: pairs are ranks of words in sorted order."""

    def __init__(self, a: Acceptor):
        self.a = a
        self._both: dict[tuple[int, int], np.ndarray] = {}
        self._edits: dict[int, np.ndarray] = {}

    def both(self, q: int, r: int) -> np.ndarray:
        """Ranks (in q, in r) of the endings that both states accept."""
        if q == r:
            return np.repeat(np.arange(self.a.size[q]), 2).reshape(-1, 2)
        a, done, todo = self.a, self._both, [(q, r)]
        while todo:
            x, y = pair = todo[-1]
            if pair in done:
                todo.pop()
                continue
            steps = [(c, a.arcs[x][c], a.arcs[y][c]) for c in a.arcs[x] if c in a.arcs[y]]
            if missing := [(s, t) for _, s, t in steps if s != t and (s, t) not in done]:
                todo.extend(missing)
                continue
            parts = [np.zeros((1, 2), np.int64)] if a.final[x] and a.final[y] else []
            for c, s, t in steps:
                rest = np.repeat(np.arange(a.size[s]), 2).reshape(-1, 2) if s == t else done[s, t]
                if len(rest):
                    parts.append(rest + (a.first[x][c], a.first[y][c]))
            done[pair] = np.concatenate(parts) if parts else _NONE
            todo.pop()
        return done[q, r]

    def edits(self, q: int) -> np.ndarray:
        """Ranks of the endings of q that the transducer relates by an edit of their first code point (of either)."""
        if q not in self._edits:
            a, parts = self.a, []
            arcs = list(a.arcs[q].items())
            for i, (c, r) in enumerate(arcs):
                for d, s in arcs[i + 1:]:  # replaced
                    if len(p := self.both(r, s)):
                        parts.append(p + (a.first[q][c], a.first[q][d]))
                # one side reads c, the other nothing; the rest must not start with c, or the words differ later on
                if a.final[r] and a.final[q]:
                    parts.append(np.array([[a.first[q][c], 0]], np.int64))
                for d, s in a.arcs[r].items():
                    if d != c and d in a.arcs[q] and len(p := self.both(s, a.arcs[q][d])):
                        parts.append(p + (a.first[q][c] + a.first[r][d], a.first[q][d]))
            self._edits[q] = np.concatenate(parts) if parts else _NONE
        return self._edits[q]

    def pairs(self) -> Iterator[np.ndarray]:
        """Every accepted pair once, in one order of its words."""
        todo = [(self.a.root, 0)]
        while todo:
            q, at = todo.pop()
            if self.a.size[q] < 2:
                continue
            if len(p := self.edits(q)):
                yield p + at
            todo.extend((r, at + self.a.first[q][c]) for c, r in self.a.arcs[q].items())


def near_in(words: list[str], counts: np.ndarray, skip: int = 0) -> dict[str, list]:
    """(word, n_near, top, top_word) of sorted distinct words that share their first ``skip`` code points:
    for each with near words, their number and the best one."""
    found = list(Composition(Acceptor([w[skip:] for w in words])).pairs())
    if not found:
        return {"word": [], "n_near": [], "top": [], "top_word": []}
    pairs = np.concatenate(found)
    pairs = np.concatenate([pairs, pairs[:, ::-1]])
    order = np.lexsort((pairs[:, 1], -counts[pairs[:, 1]], pairs[:, 0]))  # words are in code-point order
    pairs = pairs[order]
    word, start, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    best = pairs[start, 1]
    return {"word": [words[i] for i in word], "n_near": n.tolist(), "top": counts[best].tolist(),
            "top_word": [words[i] for i in best]}


def near_in_partitions(words: DataFrame) -> DataFrame:
    """(word, n_near, top, top_word) of pairs that differ after the column ``prefix``: partitions come sorted
    to a task and are held one at a time."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("top", pa.int64()), ("top_word", pa.string())])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            out = near_in(held, np.array(counts, np.int64), len(prefix))
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        prefix, held, counts = "", [], []
        for b in batches:
            for p, w, n in zip(*(b[c].to_pylist() for c in ("prefix", "word", "n")), strict=True):
                if p != prefix:
                    if len(held) > 1:
                        yield done()
                    prefix, held, counts = p, [], []
                held.append(w)
                counts.append(n)
        if len(held) > 1:
            yield done()

    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-words.count() // LIMIT))
    return (words.select("prefix", "word", "n").repartition(tasks, "prefix").sortWithinPartitions("prefix", "word")
            .mapInArrow(compose, "word string, n_near long, top long, top_word string"))


# ---- 4. edits within the prefix -----------------------------------------------------------
def near_at(words: DataFrame, at: int) -> DataFrame:
    """(word, n_near, top, top_word) of pairs whose words first differ at code point ``at``."""
    cut = words.filter(F.length("word") > at).select(
        F.concat(F.expr(f"substring(word, 1, {at})"), F.expr(f"substring(word, {at + 2})")).alias("key"),
        F.expr(f"substring(word, {at + 1}, 1)").alias("c"), "word", "n")
    whole = words.select(F.col("word").alias("key"), F.lit(None).cast("string").alias("c"), "word", "n")
    follows = F.expr(f"substring(key, {at + 1}, 1)")
    groups = (cut.unionByName(whole).groupBy("key").agg(F.collect_list(F.struct("word", "n", "c")).alias("members"))
              .filter(F.size("members") > 1).withColumn("follows", follows)
              .select("members", "follows", F.explode("members").alias("m")))

    def near(o):  # a cut word and a whole one: only where the rest does not go on with the cut code point
        cut_c = F.coalesce(F.col("m.c"), o["c"])
        one_whole = F.col("m.c").isNull() | o["c"].isNull()
        return (o["word"] != F.col("m.word")) & (~one_whole | (cut_c != F.col("follows")))

    others = groups.select(F.col("m.word").alias("word"), F.filter("members", near).alias("o")).filter(F.size("o") > 0)
    best = F.array_min(F.transform("o", lambda o: F.struct((-o["n"]).alias("n"), o["word"].alias("word"))))
    return (others.select("word", F.size("o").cast("long").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("top"), F.col("b.word").alias("top_word")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, top, top_word) of the words of (word, n) that have a near word."""
    found = []
    for at in range(PREFIX):
        found.append(near_at(words, at))
    depth, left = PREFIX, words.withColumn("prefix", F.expr(f"substring(word, 1, {PREFIX})"))
    while True:
        crowded = stored(left.groupBy("prefix").count().filter(F.col("count") > LIMIT).select("prefix"), "spell-crowded")
        if crowded.isEmpty():
            found.append(near_in_partitions(left))
            break
        found.append(near_in_partitions(left.join(crowded, "prefix", "left_anti")))
        inside = stored(left.join(crowded, "prefix", "left_semi").select("word", "n"), "spell-inside")
        found.append(near_at(inside, depth))
        depth += 1
        left = inside.filter(F.length("word") >= depth).withColumn("prefix", F.expr(f"substring(word, 1, {depth})"))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    top = F.min(F.struct((-F.col("top")).alias("n"), F.col("top_word").alias("word"))).alias("b")
    return (every.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
            .select("word", "n_near", (-F.col("b.n")).alias("top"), F.col("b.word").alias("top_word")))


# ---- 6. roots ------------------------------------------------------------------------------
def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the chain of forms. Each round doubles the step."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = stored(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                        F.col("further").isNotNull().alias("moved")), "spell-roots")
        moved = not nxt.filter("moved").isEmpty()
        at = nxt.drop("moved")
        if not moved:
            return at


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word."""
    words = stored(vocabulary(docs, doc_id, text), "spell-words")
    is_form = F.col("top") >= RATIO * F.col("n")
    known = stored(words.join(near_words(words), "word", "left").select(
        "word", F.when(is_form, F.col("top_word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("top")).alias("form_n")), "spell-near")
    found = roots(known.filter("form IS NOT NULL"))
    out = known.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    drop_stored(words)
    return out
