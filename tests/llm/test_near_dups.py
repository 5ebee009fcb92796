import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lapsekit.llm import near_dups as N


def word_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def plain(docs):
    """Components by comparing all documents that share a shingle."""
    sets = {d: word_set(t) for d, t in docs.items()}
    up = {d: d for d in docs}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    holders, shared = defaultdict(list), defaultdict(int)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for h in holders.values():
        for i, a in enumerate(h):
            for b in h[:i]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {d: (len(sets[d]), top(d), top(d) == d) for d in docs}


def run(spark, docs):
    rows = [(d, t, "x", 1) for d, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n int")
    got = N.near_duplicates(df).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}


def changed(rnd, text, share):
    return " ".join(f"c{rnd.randrange(10**9)}" if rnd.random() < share else w for w in text.split())


def text(rnd, n):
    return " ".join(f"w{rnd.randrange(3000)}" for _ in range(n))


def test_brute_force(spark, small_docs):
    docs = dict(small_docs[1])
    rnd = random.Random(4)
    n = 10_000
    for size in (3, 6, 10, 30, 120, 400):
        for _ in range(4):
            base = text(rnd, size)
            for share in (0, 0, 0.004, 0.01, 0.02, 0.03, 0.05):
                n += 1
                docs[n] = changed(rnd, base, share)
    docs |= {1: None, 2: "", 3: " \n\t ", 4: "One two", 5: "one TWO", 6: "ÀB c", 7: "àB c", 8: "a\x0bb\x0cc d e f", 9: "a b c d e f",
             n + 1: "long " + text(rnd, 30_000)}
    assert run(spark, docs) == plain(docs)


def test_large_mixed_bands(spark, monkeypatch):
    """Chains and crowds that a comparison with the first member alone does not settle."""
    monkeypatch.setattr(N, "LARGE", 12)
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "LEVELS", ((1, 60), (2, 40)))  # bands so short that unlike documents meet
    rnd = random.Random(8)
    docs, n = {}, 0
    words = text(rnd, 150).split()
    for k in range(40):  # each a little further from the first
        docs[n := n + 1] = " ".join(words[k:k + 100])
    common = text(rnd, 60)
    for _ in range(25):  # a common passage, else unlike
        docs[n := n + 1] = common + " " + text(rnd, 30)
    assert run(spark, docs) == plain(docs)


def test_repeated_rows_nulls_and_empty(spark):
    t = "a b c d e f g h"
    df = spark.createDataFrame([(2, t), (2, t), (1, t), (None, t), (5, None), (5, "z")], "doc_id long, text string")
    got = sorted((tuple(r) for r in N.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(2, 4, 1, False), (2, 4, 1, False), (1, 4, 1, True), (None, 4, None, True), (5, 0, 5, True), (5, 1, 5, True)], key=repr)
    assert N.near_duplicates(df.limit(0)).collect() == []


def test_components(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    rnd.shuffle(edges)
    up = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {r["id"]: r["component"] for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: m for x, m in up.items() if any(a != b and x in (a, b) for a, b in edges)}


def test_registers_agree_with_the_similarity():
    rng = np.random.default_rng(3)
    for n in (5, 20, 100, 2000):
        pool = np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.int64).astype(np.uint64))
        a, b = pool[:n], pool[n // 10:n + n // 10]
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = np.mean([(N.sketch(a, 240, s) == N.sketch(b, 240, s)).mean() for s in range(12)])
        c = N.chance(np.array([n]), np.array([n]), 240)[0]
        assert (same - c) / (1 - c) == pytest.approx(j, abs=0.06)
        assert N.may_link(np.array([n]), np.array([n]), N.sketch(a, 240)[None], N.sketch(a, 240)[None])[0]


def test_register_layout():
    r = N.registers(np.array([2**63, 2**62, 3 * 2**62, 2**40, 0], np.uint64))
    assert [x >> 10 for x in r.tolist()] == [0, 1, 0, 23, 48]
    assert r[2] & 1023 == 512 and r[0] & 1023 == 0


def linked_from(docs, percent):
    """Components of the documents' sets by comparing all pairs."""
    sets, up = {d: word_set(t) for d, t in docs.items()}, {d: d for d in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * max(1, len(sets[a] | sets[b])):
                low, high = sorted((up[a], up[b]))
                up = {d: low if x == high else x for d, x in up.items()}
    return up


def at_eighty(rnd, groups):
    """Pairs of 300 words that differ in six spread words (81.6 percent), and others on either side of 80."""
    docs = {}
    for k in range(groups):
        words = text(rnd, 300).split()
        docs[2 * k] = " ".join(words)
        for j in range(4 + k % 5):
            words[20 + 30 * j] = f"c{k}x{j}"
        docs[2 * k + 1] = " ".join(words)
    return docs


@pytest.mark.parametrize("large", [N.LARGE, 4])
def test_lower_threshold(spark, monkeypatch, large):
    monkeypatch.setattr(N, "LARGE", large)  # 4: the longer sketches, too
    monkeypatch.setattr(N, "BLOCK", 4)
    rnd = random.Random(21)
    docs, n = at_eighty(rnd, 30), 1000
    words = text(rnd, 300).split()
    for k in range(24):  # a chain, each ten words further
        docs[n := n + 1] = " ".join((words + words)[k * 10:k * 10 + 150])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for percent in (80, 85):
        got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(df, percent=percent).collect()}
        assert got == linked_from(docs, percent)
    with pytest.raises(ValueError):
        N.near_duplicates(df, percent=79)


def test_bands_reach_the_threshold():
    for percent in (80, 85):
        for rows, bands in N.levels_for(percent):
            assert (1 - (percent / 100) ** rows) ** bands < 1e-7


def test_stage_takes_eighty(spark):
    import corpus_pipeline
    docs = at_eighty(random.Random(5), 20)
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs.items()],
                               "doc_id long, text string, lang string, source string, n_chars long")
    want = {d for d, c in linked_from(docs, 80).items() if c == d}
    assert want != {d for d, c in linked_from(docs, 85).items() if c == d}
    assert {r["doc_id"] for r in corpus_pipeline.near(spark, df, "").collect()} == want
