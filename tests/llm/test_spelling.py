"""Spelling variants against a plain search over all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lapsekit.llm import spelling

SCHEMA = "doc_id long, text string"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def count(rows):
    c = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in w)
            h = zlib.crc32(f"{'null' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def plain(rows):
    v = count(rows)
    holes = defaultdict(set)
    for w in v:
        for i in range(len(w)):
            holes[len(w), w[:i] + "\0" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= group - {a}
    for w in v:
        for i in range(len(w)):
            if (s := w[:i] + w[i + 1:]) in v:
                near[w].add(s)
                near[s].add(w)
    form = {}
    for w in v:
        if near[w]:
            best = min(near[w], key=lambda x: (-v[x], x))
            if v[best] >= 5 * v[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w, ""), root(w), n, len(near[w]), v.get(form.get(w, ""), 0)) for w, n in v.items())


def check(spark, rows):
    got = spelling.group_variants(spark.createDataFrame(rows, SCHEMA)).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted((w, f or "", r, n, k, m or 0) for w, f, r, n, k, m in got.collect()) == plain(rows)


def test_pairs_of_a_composition_are_all_pairs_one_edit_apart():
    rng = random.Random(2)
    for _ in range(40):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(0, 7))) for _ in range(rng.randrange(1, 120))})
        a = spelling.Acceptor(words)
        found = [tuple(sorted(map(int, p))) for part in spelling.Composition(a).pairs() for p in part]
        assert len(found) == len(set(found))
        assert {(words[i], words[j]) for i, j in found} == {
            (x, y) for i, x in enumerate(words) for y in words[i + 1:] if one_edit(x, y)}


def test_acceptor_is_minimal():
    words = sorted(x + y for x in ["ab", "cd", "ef"] for y in ["ing", "ings", "ed"])
    a = spelling.Acceptor(words)
    endings = set()
    for q in range(len(a.arcs)):
        todo, got = [(q, "")], set()
        while todo:
            s, p = todo.pop()
            got |= {p} if a.final[s] else set()
            todo += [(r, p + c) for c, r in a.arcs[s].items()]
        endings.add(frozenset(got))
    assert len(endings) == len(a.arcs) and a.size[a.root] == len(words)


def test_best_near_word_by_count_then_code_points():
    words = ["abcdef", "abcdeg", "abcdeh", "abcdeé"]
    got = spelling.near_in(words, np.array([3, 9, 9, 9]))
    assert dict(zip(got["word"], got["top_word"])) == {"abcdef": "abcdeg", "abcdeg": "abcdeh", "abcdeh": "abcdeg", "abcdeé": "abcdeg"}
    assert got["n_near"] == [3, 3, 3, 3]


@pytest.mark.parametrize("limit,seed", [(20_000, 1), (5, 2), (1, 3)])
def test_random_words(spark, monkeypatch, limit, seed):
    monkeypatch.setattr(spelling, "LIMIT", limit)
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(5, 9))) for _ in range(25)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(120):
            w = rng.choice(stems[:1 + int(25 * rng.random() ** 2)])
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", rng.choice("abé"), w[i] + w[i]]) + w[i + 1:]
            text.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((d, rng.choice([" ", ", ", "1"]).join(text)))
    check(spark, rows)


def test_a_chain_of_forms(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 700, "aabbbb": 4000}
    rows = [(1000 + i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    rows = [(d, t) for d, t in rows if not any(zlib.crc32(f"{d}:{w}".encode()) % 199 == 0 for w in counts)]
    assert len(rows) == 5
    check(spark, rows)


def test_deleted_code_points_make_variants(spark):
    rows = [(d, "Kindergarten naïveté") for d in range(15_000)]
    assert any(len(w) == 11 for w in count(rows))
    check(spark, rows)


def test_nulls_empties_repeats_and_long_runs(spark):
    run = "ab" * 3000
    rows = [(1, None), (2, ""), (3, "123 ---"), (None, "nullwords " * 7), (4, "ÀÉÎõü×÷ " * 6), (4, "ÀÉÎõü×÷ " * 6),
            (5, (run + " ") * 6), (6, (run[:-1] + " ") * 6), (7, ("x" + run + " ") * 40), (8, ("ab" * 2999 + "ba ") * 9)]
    check(spark, rows)


def test_empty_table_and_other_columns(spark):
    assert spelling.group_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "letters " * 5, 2, "w")], SCHEMA + ", n int, word string")
    assert [tuple(r) for r in spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()] == [
        ("letters", None, "letters", 5, 0, None)]


def test_given_documents(spark, small_docs):
    _, texts = small_docs
    check(spark, sorted(texts.items()))
