"""The Jaccard join against brute force over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from lapsekit.llm import ngram_join as nj

SCHEMA = "doc_id long, text string"


def gram_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", lowered)
    k = min(3, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def plain(rows, percent=90):
    """(doc_id, n_shingles, component_id) of every row, sorted."""
    sets = [gram_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return key((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def check(spark, rows, percent=90, **more):
    got = nj.link_documents(spark.createDataFrame(rows, SCHEMA), percent=percent)
    got = key(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect())
    assert got == plain(rows, percent)


def edited(rng, words, share):
    """The words, some of them exchanged, left out or doubled."""
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            out.append(f"z{rng.randrange(9999)}")
        elif r < share * 2 / 3:
            out += [w, w]
        elif r >= share:
            out.append(w)
    return out


@pytest.mark.parametrize("seed,percent", [(1, 90), (2, 90), (3, 70), (4, 100)])
def test_families_of_all_sizes(spark, seed, percent):
    rng = random.Random(seed)
    rows = []
    for size in [1, 2, 3, 4, 9, 10, 11, 12, 20, 21, 40, 95, 300, 1500]:
        words = [f"w{rng.randrange(40 if size < 20 else 5000)}" for _ in range(size)]
        for _ in range(6):
            rows.append((0, " ".join(edited(rng, words, rng.choice([0, 0.005, 0.01, 0.02, 0.05, 0.1])))))
    rng.shuffle(rows)
    check(spark, [(i, t) for i, (_, t) in enumerate(rows)], percent)


def test_a_crowd_of_copies_that_only_its_middle_links(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 16)
    rng = random.Random(7)
    middle = [f"m{i}" for i in range(300)]
    texts = []
    for _ in range(120):  # each within the threshold of the middle, few of each other
        w = list(middle)
        for i in rng.sample(range(300), 4):
            w[i] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, " ".join(middle))]
    check(spark, rows)


def test_every_linked_pair_shares_a_tile():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.choice([10, 15, 19, 20, 37, 100, 260, 800])
        a = {rng.getrandbits(64) for _ in range(n)}
        percent = rng.choice([60, 80, 90, 95])
        b = set(a)
        while True:
            c = set(b)
            (c.discard(rng.choice(sorted(c))) if rng.random() < 0.5 else c.add(rng.getrandbits(64)))
            if 100 * len(a & c) < percent * len(a | c):
                break
            b = c
        if a == b:
            continue
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        assert set(nj.tile_keys(x, percent).tolist()) & set(nj.tile_keys(y, percent).tolist())
        words = min(len(nj.bitmap(x)), len(nj.bitmap(y)))
        differing = int(np.bitwise_count(nj.folded(nj.bitmap(x), words) ^ nj.folded(nj.bitmap(y), words)).sum())
        assert differing <= len(a ^ b) and nj.may_link(len(a), len(b), differing, percent)


def test_nulls_empties_repeats_ties_and_long_texts(spark):
    rng = random.Random(1)
    long = " ".join(f"l{rng.randrange(10 ** 6)}" for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one"), (None, "one two"), (None, "only here x"),
            (7, "same id, one text of four words more"), (7, "same id, but quite another text with words"), (8, "ÀB c d"),
            (9, "àb c d"), (10, long), (11, long + " tail"), (11, long + " tail"), (12, long[:90_000])]
    check(spark, rows)


def test_empty_table_and_other_columns(spark):
    assert nj.link_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "a b c", 5, 7), (2, "a b c", 5, 7)], SCHEMA + ", component_id int, rid int")
    assert key(tuple(r) for r in nj.link_documents(df).collect()) == [(1, 1, 1), (2, 1, 1)]
    with pytest.raises(ValueError):
        nj.link_documents(df, percent=49)


def test_given_documents(spark, small_docs):
    df, texts = small_docs
    got = key(tuple(r) for r in nj.link_documents(df).collect())
    assert got == plain(sorted(texts.items()))
