import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from lapsekit.llm import packing, secret_scan
from test_line_dedup import plain as dedup_plain
from test_near_dups import linked_from
from test_quality_rules import plain as quality_plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, each from the written result of the one before."""
    from lapsekit.llm.common import stored
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(("documents", docs))
    for name, fn in corpus_pipeline.STAGES:
        docs = stored(fn(spark, docs, SF), f"test-{name}")
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dups", "secret_scan", "packing"]
    for n in ("quality_rules", "line_dedup", "near_dups", "secret_scan"):
        assert stages[n].dtypes == stages["documents"].dtypes
        assert all(r["n_chars"] == len(r["text"]) for r in stages[n].collect())


def test_quality_rules_reject_only_what_they_should(stages):
    kept = {d: t for d, t in texts(stages["documents"]).items() if quality_plain(t)["kept"]}
    assert texts(stages["quality_rules"]) == kept and len(kept) > 100


def test_line_dedup(stages):
    assert texts(stages["line_dedup"]) == dedup_plain(texts(stages["quality_rules"]))


def test_one_document_of_each_group(stages):
    before = texts(stages["line_dedup"])
    component = linked_from(before, corpus_pipeline.NEAR_PERCENT)
    assert texts(stages["near_dups"]) == {d: t for d, t in before.items() if component[d] == d}


def test_near_stage_goes_by_rows(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(200)) for k in "ab")
    a2, b2 = a + " tail", b + " tail"
    rows = [(1, a), (2, a2), (2, b), (3, b2), (4, "short one"), (None, "short one"), (5, None), (5, None), (6, ""),
            (None, "no id here"), (None, "no id here")]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near(spark, df, "")
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted(
        [(1, a), (2, b), (4, "short one"), (5, ""), (5, ""), (6, ""), (0, "no id here")])


def test_secrets_are_gone_and_nothing_else(stages):
    before, after = texts(stages["near_dups"]), texts(stages["secret_scan"])
    assert before.keys() == after.keys()
    for d, t in before.items():
        if not secret_scan.interesting(t):
            assert after[d] == t
        for s in secret_scan.base_spans(t):
            a, b = secret_scan.secret_part(t, s)
            assert t[a:b] not in after[d]


def test_packed_pieces_cover_every_document(stages):
    import public_tokenizers
    t = packing.tokens(public_tokenizers.path("byte_bpe_50k.json"))
    rows, lengths, ends = stages["packing"].collect(), {}, {}
    for r in rows:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert lengths == {d: len(t.encode(x)) // 4 + 1 for d, x in texts(stages["secret_scan"]).items()}
    for parts in ends.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.MAX_TOKENS


def test_empty_table_and_nulls(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{k} text{k}" for k in range(40))
    for rows in ([], [(1, None, None, None, None), (None, good, "en", None, 5), (2, "", "en", "s", 0), (3, good, None, "s", 1)]):
        docs = spark.createDataFrame(rows, schema)
        for _, fn in corpus_pipeline.STAGES[:-1]:
            out = fn(spark, docs, SF)
            assert out.columns == docs.columns
            out.collect()
        assert packing.pack(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).count() >= len(rows)


def test_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names


def test_every_query_runs_on_the_smallest_tables(spark):
    from lapsekit.llm.queries import QUERIES
    rows = {"pages": spark.read.parquet(f"{SF}/pages.parquet").count(), "documents": spark.read.parquet(f"{SF}/documents.parquet").count()}
    for name in ("op1_warc", "op6_url_filters", "op10_html_text", "op3_piece_codec", "op4_edit_fingerprints", "op7_quality_rules",
                 "op8_line_dedup", "op9_secret_scan"):
        n = QUERIES[name](spark, SF).count()
        assert n == rows["pages" if name.split("_")[0] in ("op1", "op6", "op10") else "documents"], name


def test_oracles_agree(spark):
    import duckdb
    from lapsekit.llm.oracles import ORACLES
    from lapsekit.llm.queries import QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SF)
        got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        want = sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in cur.fetchall()), key=repr)
        assert sorted(df.columns) == sorted(cols) and got == want, name
