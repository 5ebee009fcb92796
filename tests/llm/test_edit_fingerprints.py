import hashlib
import random

import pytest

from lapsekit.llm import edit_fingerprints as E


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def plain_walk(text):
    """The walk of one text, step by step."""
    if not text:
        return "0:"
    sym = E.symbols(text).tolist()
    want = {int(j) for j in E.sampled_steps(len(text))}
    out, p = [], 0
    for j in range(2 * len(text)):
        s = sym[p] if p < len(sym) else None
        if j in want:
            out.append("--" if s is None else f"{s & 255:02x}")
        if s is not None:
            p += int(E._BITS[(s + int(E._SHIFT[j % 65536])) % 65536])
    return f"{len(text)}:{''.join(out)}"


def test_walks_side_by_side_equal_single_ones():
    texts = [words(k, 1 + k % 90) for k in range(150)] + ["", "a", "ab", "💩" * 50, words(7, 5000), "x" * 3000]
    assert E.walk_all(texts) == [plain_walk(t) for t in texts]
    assert E.walk_all(texts[:3]) == E.walk_all(texts)[:3]


def test_likeness_follows_edits():
    t = words(1, 2000)
    near = t[:5000] + "zz" + t[5003:]
    a, b, c = E.walk_all([t, near, words(2, 2000)])
    assert E.likeness(a, a) == 1.0 and E.likeness(a, b) > 0.8 > 0.1 > E.likeness(a, c)
    assert E.likeness(a, b) == E.likeness(b, a)
    e = E.walk_all([E.edited(t, words(3, 2000))])[0]
    assert 0.5 < E.likeness(a, e) < 0.8
    assert (E.likeness("0:", "0:"), E.likeness(a, "0:")) == (1.0, 0.0)


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (d, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        f, fe, fn = map(plain_walk, (t, e, n))
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), f, fe, E.likeness(f, fe), E.likeness(f, fn))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 60])
def test_next_document_across_ranges(spark, n):
    rnd = random.Random(n)
    ids = rnd.sample(range(10 * n + 5), n)
    rows = [(d, rnd.choice([None, "", words(d, 1 + d % 60)])) for d in ids]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, h int").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in E.fingerprints(df).collect()}
    assert got == expected(rows)


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(4, "abc def"), (4, "abc def"), (4, "xyz"), (None, "nobody"), (None, None), (9, words(1, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = E.fingerprints(df).collect()
    assert sorted(r["n_chars"] for r in got) == sorted(len(t or "") for _, t in rows)
    assert sum(r["doc_id"] is None for r in got) == 2
    assert E.fingerprints(df.limit(0)).collect() == []


def test_long_text(spark):
    df = spark.createDataFrame([(1, words(5, 60_000)), (2, "b")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_chars"] for r in E.fingerprints(df).collect()}
    assert got == {1: len(words(5, 60_000)), 2: 1}


def test_bands_and_verification(spark):
    t = words(1, 300)
    near = t[:700] + "q" + t[700:]
    fps = E.walk_all([t, near, words(2, 300), ""])
    found = spark.createDataFrame([(k, f) for k, f in enumerate(fps)], "doc_id long, fingerprint string")
    keys = {}
    for r in E.bands(found).collect():
        keys.setdefault(r["doc_id"], set()).add(r["band"])
    assert keys[0] & keys[1] and not keys[0] & keys[2] and 3 not in keys
    assert E.edit_distance_within(t, near, 5) == 1 and E.edit_distance_within(t, words(2, 300), 5) is None
    assert E.edit_distance_within("kitten", "sitting", 3) == 3 and E.edit_distance_within("", "", 0) == 0
