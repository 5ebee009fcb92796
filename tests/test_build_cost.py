"""Stored builds: what is done to every row is no more than its result asks for, and the results stay the same."""

import tempfile
import threading

from pyspark.sql import functions as F

from lapsekit.functions.text import WHITESPACE, trim_ws
from lapsekit.plans.layers import Layers
from lapsekit.sources import sinks

ODD = [None, "", " ", "a", " a", "a　", "\u0085", "é", "é ", "x é", "\t x y \n", "\x7f", "\x7f ", "a​", "ab ",
       "\U0001f600 ", " \U0001f600", "~", "!", "! ", "\x1f", "\x00a", "a\x00", *[f"{w}k{w}" for w in WHITESPACE],
       *[f"k{w}" for w in WHITESPACE], *[f"{w}k" for w in WHITESPACE]]
BYTES = [b"\x85", b"a\x85", b"\xe2 ", b"a\xe2 ", b"\xe2a", b"\xff ", b"\xc2", b" \xc2", b"a\xc2", b"\xf0a ", b"\x80\x80a"]


def test_trim_takes_the_same_from_any_text(spark):
    texts = spark.createDataFrame([(x,) for x in ODD], "t string").unionByName(
        spark.createDataFrame([(bytearray(x),) for x in BYTES], "b binary").select(F.col("b").cast("string").alias("t")))
    wrong = texts.filter(~trim_ws("t").eqNullSafe(F.btrim("t", F.lit(WHITESPACE))))
    assert wrong.isEmpty() and texts.count() == len(ODD) + len(BYTES)
    assert texts.filter(trim_ws("t") == "k").count() == 3 * len(WHITESPACE)


def test_plain_values_are_not_looked_up_in_the_set_of_blanks(spark):
    plan = spark.range(1).select(trim_ws(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan and "btrim" in plan


def _encodings(spark, path):
    """Encodings of each column in the files below ``path``, as their footers state them."""
    import pyarrow.parquet as pq
    from pathlib import Path
    out = {}
    for f in Path(path).rglob("*.parquet"):
        group = pq.ParquetFile(f).metadata.row_group(0)
        for i in range(group.num_columns):
            column = group.column(i)
            out.setdefault(column.path_in_schema, set()).update(column.encodings)
            assert column.statistics is not None and column.statistics.has_min_max
    return out


def test_ids_are_stored_without_a_dictionary_and_with_their_range(spark):
    rows = spark.range(2000).select(F.concat(F.lit("C"), "id").alias("coupon_user_id"), F.lit("coupon").alias("event_type"),
                                    F.lit("2025-03-07").cast("date").alias("day"))
    path = f"{tempfile.mkdtemp(prefix='lapsekit-plain-')}/t"
    back = sinks.materialise(rows, path, partition_month="day", cluster=["coupon_user_id"])
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    found = _encodings(spark, path)
    assert not any("DICTIONARY" in e for e in found["coupon_user_id"])
    assert any("DICTIONARY" in e for e in found["event_type"])


def test_feeds_are_stored_by_concurrent_jobs(golden, monkeypatch):
    both, seen = threading.Barrier(2, timeout=60), []
    write = Layers._write

    def meet(self, df, path, *rest):
        if path.endswith(("stg_coupon_events", "stg_cashback_transactions")):
            both.wait()                                            # broken, were one written after the other
            seen.append(path)
        return write(self, df, path, *rest)
    monkeypatch.setattr(Layers, "_write", meet)
    stored = Layers(golden.raw, golden.spec, materialise=True)
    assert stored.fact.exceptAll(golden.fact).isEmpty() and golden.fact.exceptAll(stored.fact).isEmpty()
    assert len(seen) == 2
    stored.drop()


def test_copies_of_orders_are_made_in_generated_code(spark):
    from lapsekit.sources.adapter import adapter_cashback
    orders = spark.range(1, 4000).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "substring('FPO', cast(id % 3 AS int) + 1, 1) AS o_orderstatus",
        "cast(id AS double) + 0.5 AS o_totalprice", "timestamp'2025-03-07 10:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    feed = adapter_cashback(orders)
    assert "lambda" not in feed._jdf.queryExecution().executedPlan().toString()      # evaluated row by row, not compiled
    keys = range(1, 4000)
    want = ([(f" T{k}  " if k % 130 == 17 else f"T{k}", "1-URGENT", k + 0.5) for k in keys for _ in range(2 if k % 100 == 0 else 1)]
            + [(f"T{k}", "1-URGENT", k + 1.5) for k in keys if k % 250 == 1] + [(f"X{k}", "9-OTHER", k + 0.5) for k in keys if k % 300 == 2])
    got = [(r[0], r[1], float(r[2])) for r in feed.select("transaction_id", "source", "amount_sar").collect()]
    assert sorted(got) == sorted(want)
    assert len(feed.columns) == 8
