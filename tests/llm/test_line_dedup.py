from lapsekit.llm import line_dedup as L


def plain(docs):
    """Texts after removal, by brute force over the documents in (doc_id, line) order."""
    seen, out = set(), {}
    for d in sorted(docs):
        if docs[d] is None:
            out[d] = None
            continue
        lines = docs[d].split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for a, b, c in zip(full, full[1:], full[2:], strict=False):
            w = (lines[a], lines[b], lines[c])
            if w in seen:
                gone |= {a, b, c}
            seen.add(w)
        out[d] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def run(spark, docs):
    df = spark.createDataFrame([(d, t, 7, "h") for d, t in docs.items()], "doc_id long, text string, lines int, h string")
    out = L.dedup_lines(df, removed="removed")
    assert out.columns == [*df.columns, "removed"]
    return {r["doc_id"]: r for r in out.collect()}


def test_brute_force(spark, small_docs):
    _, rows = small_docs
    base = "one a\ntwo b\nthree c\nfour d"
    docs = {10_000 + k: t for k, t in rows.items()} | {
        0: base, 1: "x\n" + base + "\ny", 2: "one a\ntwo b", 3: base, 4: "two b\n\nthree c\n \nfour d", 5: None, 6: "",
        7: "\n\n\n", 8: "q\nq\nq\nq\nq\nq", 9: "\n".join(f"l{k}" for k in range(5000)) + "\n" + base,
        11: "one a\r\ntwo b\r\nthree c\r\n"}
    got, want = run(spark, docs), plain(docs)
    for d in docs:
        assert got[d]["text"] == want[d], d
        assert len(got[d]["removed"]) == (0 if docs[d] is None else docs[d].count("\n") - want[d].count("\n")
                                          + (1 if not want[d] and docs[d] else 0)), d


def test_repeated_rows_and_null_ids(spark):
    t = "a 1\nb 2\nc 3\nd 4"
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (6, "z\n" + t)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in L.dedup_lines(df).collect()), key=repr)
    assert got == [(5, ""), (5, ""), (6, "z"), (None, t)]


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
