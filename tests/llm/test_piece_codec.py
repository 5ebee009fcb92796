import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapsekit.llm import piece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return C.codec(PATH)


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def best(v, text):
    """The highest score and its segmentation, by plain dynamic programming over all pieces."""
    s = [(0.0, [])] + [None] * len(text)
    for k in range(1, len(text) + 1):
        for i in range(max(0, k - v.longest), k):
            if s[i] is None:
                continue
            p = v.pieces.get(text[i:k])
            if p is not None:
                new = (s[i][0] + p[0], [*s[i][1], p[1]])
            elif k == i + 1:
                new = (s[i][0] + v.unknown, [*s[i][1], *(v.byte_ids[b] for b in text[i:k].encode())])
            else:
                continue
            if s[k] is None or new[0] > s[k][0]:
                s[k] = new
    return s[-1]


def score(v, found):
    back = {i: s for s, i in v.pieces.values()}
    return sum(back[i] for i in found if i in back)


TEXTS = ["the quick  brown\tfoxes 梦 ñé 💩", "a", "", " ", "  a  ", "a\n\nb", "therethethenthere" * 30, "x" * 300, "▁a ▁",
         "deutsche Wörter und français", "\x00\x01", "𝔘𝔫𝔦" * 9]


def test_equals_plain_search(codec, small_docs):
    v = codec.vocabulary
    for t in TEXTS + [t[:400] for t in small_docs[1].values()][:40]:
        if t:
            marked = C.MARK + t.replace(" ", C.MARK)
            want = best(v, marked)[1]
            assert ids(codec.encode(t)) == want, t
            assert [i for part in v.viterbi(marked) for i in part] == want


def test_equals_the_best_of_the_library(codec):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1  # the same pieces and scores, searched by the library
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    for w in ["the", "quick", "brown", "thonbletion", "erkeitung", "ñciónñ", "foxes"]:
        assert ids(codec.encode(w)) == lib.nbest_encode_as_ids(w, 5)[0], w


def test_commits_before_the_end(codec):
    parts = list(codec.vocabulary.viterbi("there" * 400))
    assert len(parts) > 10 and max(map(len, parts)) < 40


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(text):
    c = C.codec(PATH)
    assert c.decode(c.encode(text)) == text.replace(C.MARK, " ")
    assert ids(c.encode(text)) == (best(c.vocabulary, C.MARK + text.replace(" ", C.MARK))[1] if text else [])


def test_bounded_memory():
    m = C.Memory(lambda s: s.encode(), most=3)
    assert [m[x] for x in "abcdeabcde"] == [x.encode() for x in "abcdeabcde"]
    assert len(m) <= 3 and len(m.older) <= 3


def test_columns(spark):
    rows = [(1, "a b", 1), (2, None, 2), (3, "", 3), (3, "", 3), (None, "z " * 100_000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = C.decode(C.encode(df, PATH), PATH, into="back")
    assert out.columns == ["doc_id", "text", "ids", "back"]
    got = out.collect()
    assert sorted((r["doc_id"] or 0, r["back"]) for r in got if r["text"]) == [(0, "z " * 100_000), (1, "a b")]
    assert [r["ids"] for r in got if r["doc_id"] == 2] == [None]
    assert [bytes(r["ids"]) for r in got if r["doc_id"] == 3] == [b"", b""]
    assert out.limit(0).collect() == []


def test_many_rows_keep_their_place(spark):
    df = spark.range(1000).selectExpr("id", "concat('doc ', id) AS text").coalesce(1)
    got = C.decode(C.encode(df, PATH), PATH, into="back").collect()
    assert all(r["text"] == r["back"] == f"doc {r['id']}" for r in got) and len(got) == 1000
