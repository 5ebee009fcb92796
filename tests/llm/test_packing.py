import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lapsekit.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


ODD = ["a  b\n\n\n c'd  \n", " 's", "a 's x're y \x1c z　 w\n ", "<|endoftext|> x", "", " ", "\n", "  ", "a ", " a", "a b  c",
       "x \n y", "x\n \ny", "w### x%%%'s y.'s z_'re q'*** ab.cd ef.. gh.'", "##a b##", "it's 12 3a b4 ñandú é", "💩 💩💩", "a\tb \tc\t d", "end\n"]


def test_ids_equal_the_tokenizer(plain, small_docs):
    t = P.tokens(PATH)
    for x in ODD + list(small_docs[1].values()):
        assert np.frombuffer(t.encode(x), "<u4").tolist() == plain(x), x


def test_random_white_space(plain):
    t, rnd = P.tokens(PATH), random.Random(3)
    for _ in range(600):
        x = "".join(rnd.choice(["a", "bc", " ", " ", "\n", "\t", "'s", "1", ".", "#", "'", "ß", " ", "é", "\x1c"]) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(t.encode(x), "<u4").tolist() == plain(x), repr(x)


def check(rows, docs, plain, most=P.MAX_TOKENS):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for d, texts in docs.items():
        ids = [plain(texts[0] or "") + [0]] * len(texts)
        pieces = sorted(by_doc[d], key=lambda r: r["piece"])
        n = len(ids[0])
        lengths = [n] if n <= most else [n % most or most] + [most] * ((n - 1) // most)
        assert [r["length"] for r in pieces] == [x for x in lengths for _ in texts]
        for r in pieces:
            assert r["start"] == sum(lengths[:r["piece"]])
            part = np.array(ids[0][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= most
    total = sum(r["length"] for r in rows)
    return len(by_seq), -(-total // most)


def test_pack_documents(spark, small_docs, plain):
    _, texts = small_docs
    docs = {k: [t] for k, t in texts.items()} | {9_000: [None], 9_001: [""], 9_002: ["w x " * 9000], 9_003: ["twice"] * 2,
                                                 None: ["no id"]}
    rows = [(d, t, 1) for d, ts in docs.items() for t in ts]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(5)
    got = P.pack(df, PATH, with_ids=True).collect()
    sequences, least = check(got, docs, plain)
    assert sequences <= 1.02 * least + 1
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in got)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rnd = random.Random(seed)
    h = Counter()
    for _ in range(rnd.choice([0, 1, 30, 400])):
        h[rnd.choice([rnd.randint(1, 2048), rnd.randint(1, 200), 2048, 1024, 1025])] += rnd.choice([1, 2, 1000, 77_777])
    groups = P.plan_patterns(dict(h))
    used = Counter()
    for lengths, n in groups:
        assert sum(lengths) <= 2048 and n > 0
        for k in lengths:
            used[k] += n
    assert used == h
    r = P.ranges(groups)
    assert len(r["key"]) == sum(len(x) for x, _ in groups)


def test_no_worse_than_best_fit():
    rnd = random.Random(5)
    h = Counter(min(2048, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    count = sum(n for _, n in P.plan_patterns(dict(h)))
    assert count <= 1.002 * -(-sum(k * v for k, v in h.items()) // 2048) + 1


@pytest.fixture(scope="module")
def lengths(spark):
    """The histogram of the pieces of a whole table."""
    rows = P.pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).groupBy("length").count().collect()
    return {r["length"]: r["count"] for r in rows}


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_patterns_take_most_pieces_and_beat_best_fit(lengths, times):
    h = {k: v * times for k, v in lengths.items()}
    least = -(-sum(k * v for k, v in h.items()) // P.MAX_TOKENS)
    count = sum(n for _, n in P.plan_patterns(h))
    plain_count = sum(n for _, n in P._best_fit(h, [], P.MAX_TOKENS))
    assert least <= count <= plain_count
    counts = np.zeros(P.MAX_TOKENS + 1, np.int64)
    for k, v in h.items():
        counts[k] = v if k < P.MAX_TOKENS else 0
    patterns = [p for p in P.class_patterns() if min(p) >= P.LEAST_CLASS]
    fitted = np.floor(P.fit_repeats(counts, patterns, P.CLASSES))
    assert sum(n * len(p) for n, p in zip(fitted, patterns)) > 0.6 * counts.sum()


@pytest.mark.parametrize("seed", range(4))
def test_never_more_sequences_than_best_fit(seed):
    rnd = random.Random(seed)
    h = Counter(min(2048, int(rnd.lognormvariate(4 + seed, 1)) + 1) for _ in range(5_000))
    assert sum(n for _, n in P.plan_patterns(dict(h))) <= sum(n for _, n in P._best_fit(dict(h), [], P.MAX_TOKENS))


def test_nnls():
    rng = np.random.default_rng(1)
    a = rng.random((20, 40))
    want = np.where(rng.random(40) < 0.3, rng.random(40) * 10, 0)
    x = P.nnls(a, a @ want)
    assert (x >= 0).all() and np.allclose(a @ x, a @ want, atol=1e-5)
    b = -np.ones(20)
    assert not P.nnls(a, b).any()


def test_patterns_fill_a_sequence():
    p = P.class_patterns(16, 3)
    assert (16,) in p and (8, 8) in p and (6, 5, 5) in p
    assert all(sum(x) == 16 and list(x) == sorted(x, reverse=True) for x in p) and len(set(p)) == len(p)
