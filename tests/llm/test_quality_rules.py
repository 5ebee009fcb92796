import re
from collections import Counter

from lapsekit.llm import quality_rules as Q

TEXTS = [None, "", " ", "\n\n\n", "a b c a b c", "one two three " * 30, "w " * 60, "a\x0bb\x0cc\u00a0d\x85e", "é ñ 漢字 💩 " * 20,
         "#*$%&|<> " * 50, "x\nx\nx\n\n\ny\nx", " ".join(f"w{k}" for k in range(80)), "a a", "a a a a",
         "\n".join(["same line here"] * 30 + [f"l{k} m{k}" for k in range(20)]), "z" * 300_000,
         " ".join(f"q{k % 7919}" for k in range(30_000))]


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    f = dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=sum(c in "#*$%&|<>" for c in t),
             n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered))
    f["base_failed"] = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
    f["kept"] = not (f["base_failed"] or 100 * f["n_symbols"] > 10 * f["n_words"]
                     or not 2 * f["n_words"] <= f["word_chars"] <= 15 * f["n_words"]
                     or 100 * f["n_dup_lines"] > 50 * (t.count("\n") + 1))
    return f


def frame(spark, texts):
    rows = [(k, t, 5, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")


def test_features_and_verdicts(spark, small_docs):
    _, rows = small_docs
    texts = TEXTS + list(rows.values())
    got = Q.judge(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want, texts[r["doc_id"]]
        assert (r["failed_rule"] is None) == r["kept"]


def test_filter_keeps_columns_and_rows(spark):
    good = " ".join(f"word{k}" for k in range(70))
    df = frame(spark, [good, good, None, "bad"])
    out = Q.filter_documents(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(0, good, 5, "x"), (1, good, 5, "x")]


def test_empty_table(spark):
    assert Q.judge(frame(spark, [])).collect() == []
    assert Q.filter_documents(frame(spark, [])).collect() == []


def test_order_of_all_rules(spark):
    order = Q.measured_order(frame(spark, ["short"] * 50))
    assert {r.name for r, _, _ in order} == {r.name for r in Q.RULES}
    assert order[0][2] == 1.0 and all(share == 0.0 for _, _, share in order[1:])  # nothing is left behind the first
    assert all(sec >= 0.0 for _, sec, _ in order)


def test_order_comes_from_rejections_among_those_left():
    # rules 0 and 1 reject the same 60 rows, rule 2 other 30: after rule 0, rule 1 has nothing left to reject
    rejected = {(True, True, False): 60, (False, False, True): 30, (False, False, False): 10}
    assert Q.best_order([1.0, 2.0, 1.5], rejected) == [(0, 0.6), (2, 0.75), (1, 0.0)]
    assert [k for k, _ in Q.best_order([9.0, 1.0, 1.0], rejected)] == [1, 2, 0]
    assert Q.best_order([1.0, 1.0], {}) == [(0, 0.0), (1, 0.0)]


def test_a_dear_rule_costs_more(spark):
    docs = frame(spark, [" ".join(f"q{k % 97}" for k in range(400))] * 300)
    costs = {r.name: sec for r, sec, _ in Q.measured_order(docs)}
    assert costs["repeated_words"] > costs["few_words"]
