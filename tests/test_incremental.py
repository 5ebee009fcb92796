"""Month-incremental staging through a streaming query equals a full rebuild."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from lapsekit.sources.feeds import CASHBACK_SCHEMA
from lapsekit.streaming.incremental import IncrementalStaging, start_incremental_stream

D = dt.date


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batches_equal_full_rebuild(spark):
    root = tempfile.mkdtemp(prefix="lapsekit-inc-")
    inc = IncrementalStaging(spark, root, "cashback")
    b1 = [("T1", "B1", D(2025, 3, 10), "M", "N", "pending", None, Decimal(5)),
          ("T2", "B2", D(2025, 4, 2), "M", "N", "approved", D(2025, 4, 20), Decimal(7)),
          ("T3", "B3", D(2025, 5, 2), "M", "N", "pending", None, Decimal(1))]
    # late decision for T1 (old month), replay of T2, a copy of T3 dated a month earlier (moves its kept row)
    b2 = [("T1", "B1", D(2025, 3, 10), "M", "N", "approved", D(2025, 4, 25), Decimal(5)),
          ("T2", "B2", D(2025, 4, 2), "M", "N", "approved", D(2025, 4, 20), Decimal(7)),
          ("T3", "B3", D(2025, 4, 30), "M", "N", "pending", None, Decimal(1)),
          ("T4", "B4", D(2025, 6, 1), "M", "N", "approved", D(2025, 6, 9), Decimal(2))]
    inc.apply(spark.createDataFrame(b1, CASHBACK_SCHEMA), 0)
    inc.apply(spark.createDataFrame(b2, CASHBACK_SCHEMA), 1)
    inc.apply(spark.createDataFrame(b2, CASHBACK_SCHEMA), 1)      # a replayed epoch changes nothing
    assert _same(inc.staged(), inc.full_rebuild())
    t1 = inc.staged().filter("transaction_id = 'T1'").collect()[0]
    assert t1.raw_row_count == 2 and t1.status == "pending"        # keep='first': undecided copy sorts first
    assert inc.staged().filter("transaction_id = 'T3'").collect()[0].purchase_date == D(2025, 4, 30)
    assert inc.staged().count() == 4
    assert "activity_month=2025-05-01" not in inc.store.snapshot().partitions("stg_cashback")


def test_streaming_query_over_landing_folder(spark):
    root = tempfile.mkdtemp(prefix="lapsekit-stream-")
    landing = os.path.join(root, "landing")
    rows = [("T1", "B1", D(2025, 3, 10), "M", "N", "pending", None, Decimal(5)),
            ("T1", "B1", D(2025, 3, 10), "M", "N", "approved", D(2025, 4, 25), Decimal(5)),
            ("T9", "B9", D(2025, 8, 1), "M", "Z", "rejected", D(2025, 8, 3), Decimal(3))]
    spark.createDataFrame(rows, CASHBACK_SCHEMA).coalesce(1).write.mode("overwrite").parquet(landing)
    inc, q = start_incremental_stream(spark, landing, os.path.join(root, "store"), os.path.join(root, "ckpt"),
                                      fmt="parquet")
    q.awaitTermination(120)
    assert _same(inc.staged(), inc.full_rebuild())
    assert inc.staged().count() == 2


def test_incremental_event_stream_equals_full_rebuild(spark):
    from lapsekit.sources.feeds import COUPON_SCHEMA, IDENTITY_SCHEMA
    from lapsekit.streaming.incremental import IncrementalEvents
    root = tempfile.mkdtemp(prefix="lapsekit-incev-")
    idn = spark.createDataFrame([("coupon", "C1", "U1"), ("cashback", "B1", "U1"), ("cashback", "B2", "U2")],
                                IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, root, idn)
    model.apply("coupon", spark.createDataFrame(
        [("E1", "C1", D(2025, 2, 1), "M", "coupon_copy"), ("E2", "C9", D(2025, 3, 1), "M", "coupon_copy")],
        COUPON_SCHEMA), 0)
    model.apply("cashback", spark.createDataFrame(
        [("T1", "B1", D(2025, 2, 3), "M", "N", "pending", None, Decimal(5)),
         ("T2", "B2", D(2025, 5, 3), "M", "N", "approved", D(2025, 5, 9), Decimal(2))], CASHBACK_SCHEMA), 0)
    model.apply("cashback", spark.createDataFrame(
        [("T1", "B1", D(2025, 2, 3), "M", "N", "approved", D(2025, 3, 1), Decimal(5)),
         ("T3", "B2", D(2025, 7, 3), "M", "N", "approved", D(2025, 7, 9), Decimal(2))], CASHBACK_SCHEMA), 1)
    model.apply("coupon", spark.createDataFrame(
        [("E1", "C1", D(2025, 2, 1), "M", "coupon_copy")], COUPON_SCHEMA), 1)
    assert _same(model.events(), model.full_rebuild())
    assert model.events().count() == 5


def test_streaming_event_model(spark):
    from lapsekit.sources.feeds import IDENTITY_SCHEMA
    from lapsekit.streaming.incremental import IncrementalEvents
    root = tempfile.mkdtemp(prefix="lapsekit-stream-ev-")
    landing = os.path.join(root, "landing")
    rows = [("T1", "B1", D(2025, 3, 10), "M", "N", "pending", None, Decimal(5)),
            ("T1", "B1", D(2025, 3, 10), "M", "N", "approved", D(2025, 4, 25), Decimal(5)),
            ("T2", "B7", D(2025, 8, 1), "M", "Z", "approved", D(2025, 8, 3), Decimal(3))]
    spark.createDataFrame(rows, CASHBACK_SCHEMA).coalesce(1).write.mode("overwrite").parquet(landing)
    idn = spark.createDataFrame([("cashback", "B1", "U1")], IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, os.path.join(root, "store"), idn)
    _, q = start_incremental_stream(spark, landing, root, os.path.join(root, "ckpt"), fmt="parquet", model=model)
    q.awaitTermination(120)
    ev = model.events()
    assert _same(ev, model.full_rebuild())
    got = {r.source_event_id: (r.unified_user_id, r.is_unmapped_user) for r in ev.collect()}
    assert got == {"T1": ("U1", False), "T2": (None, True)}


def _land(spark, landing, name, rows):
    """One file of the landing folder, in the order of names."""
    spark.createDataFrame(rows, CASHBACK_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{landing}-{name}")
    os.makedirs(landing, exist_ok=True)
    part = next(f for f in sorted(os.listdir(f"{landing}-{name}")) if f.endswith(".parquet"))
    import shutil
    shutil.copy(os.path.join(f"{landing}-{name}", part), os.path.join(landing, f"{name}.parquet"))


BATCHES = [
    [("T1", "B1", D(2025, 1, 10), "M", "N", "pending", None, Decimal(5)),
     ("T2", "B2", D(2025, 2, 2), "M", "N", "approved", D(2025, 2, 20), Decimal(7)),
     (None, "B8", D(2025, 2, 5), "M", "N", "approved", None, Decimal(1))],
    # a late decision, a replayed row, rows without a key or a date
    [("T1", "B1", D(2025, 1, 10), "M", "N", "approved", D(2025, 3, 25), Decimal(5)),
     ("T2", "B2", D(2025, 2, 2), "M", "N", "approved", D(2025, 2, 20), Decimal(7)),
     (None, "B9", D(2025, 6, 1), "M", "N", "approved", None, Decimal(2)),
     ("T5", "B1", None, "M", "N", "pending", None, Decimal(4))],
    [("T3", "B2", D(2025, 4, 1), "M", "N", "approved", D(2025, 4, 9), Decimal(2)),
     ("T1", "B1", D(2025, 5, 1), "M", "N", "approved", D(2025, 5, 9), Decimal(5))],
]


def test_stream_of_several_batches_restart_and_second_stream(spark):
    root = tempfile.mkdtemp(prefix="lapsekit-stream3-")
    landing, store = os.path.join(root, "landing"), os.path.join(root, "store")
    for k, rows in enumerate(BATCHES[:2]):
        _land(spark, landing, f"f{k}", rows)

    def run(folder, ckpt):
        inc, q = start_incremental_stream(spark, folder, store, os.path.join(root, ckpt), fmt="parquet", max_files=1)
        q.awaitTermination(180)
        assert q.exception() is None
        return inc

    run(landing, "c1")
    _land(spark, landing, "f2", BATCHES[2])
    inc = run(landing, "c1")                                   # restart: goes on with the next epoch
    assert _same(inc.staged(), inc.full_rebuild())
    assert inc.raw().count() == sum(map(len, BATCHES))
    assert {r.transaction_id: r.raw_row_count for r in inc.staged().collect() if r.transaction_id} == \
        {"T1": 3, "T2": 2, "T3": 1, "T5": 1}
    assert inc.staged().filter("transaction_id IS NULL").count() == 2
    other = os.path.join(root, "backfill")
    _land(spark, other, "g0", [("T9", "B1", D(2025, 1, 3), "M", "N", "approved", None, Decimal(1)),
                               ("T3", "B2", D(2025, 4, 1), "M", "N", "approved", D(2025, 4, 9), Decimal(2))])
    inc = run(other, "c2")                                     # another stream, whose epochs start at 0 again
    assert inc.raw().count() == sum(map(len, BATCHES)) + 2
    assert _same(inc.staged(), inc.full_rebuild())
    assert inc.staged().filter("transaction_id = 'T3'").first().raw_row_count == 2


def test_writes_leave_the_session_settings_alone(spark):
    root = tempfile.mkdtemp(prefix="lapsekit-conf-")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    inc = IncrementalStaging(spark, root, "cashback")
    inc.apply(spark.createDataFrame(BATCHES[0], CASHBACK_SCHEMA), 0)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_keyless_rows_touch_only_their_own_month(spark):
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-null-"), "cashback")
    inc.apply(spark.createDataFrame(BATCHES[0], CASHBACK_SCHEMA), 0)
    months = inc.apply(spark.createDataFrame([(None, "B9", D(2025, 6, 1), "M", "N", "approved", None, Decimal(2))],
                                             CASHBACK_SCHEMA), 1)
    assert months == [D(2025, 6, 1)]
    assert _same(inc.staged(), inc.full_rebuild())


def test_same_epoch_of_two_streams_and_changed_replay(spark):
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-epoch-"), "cashback")
    df = [spark.createDataFrame(b, CASHBACK_SCHEMA) for b in BATCHES]
    inc.apply(df[0], 0, "a")
    inc.apply(df[1], 0, "b")
    assert inc.raw().count() == len(BATCHES[0]) + len(BATCHES[1])
    inc.apply(df[2], 0, "a")                                   # the same batch again, with other rows
    assert inc.raw().count() == len(BATCHES[1]) + len(BATCHES[2])
    assert _same(inc.staged(), inc.full_rebuild())


def test_reprocess_window_bounds_the_search(spark):
    rows = [spark.createDataFrame(b, CASHBACK_SCHEMA) for b in BATCHES]
    wide = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-w12-"), "cashback", reprocess_months=12)
    narrow = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-w1-"), "cashback", reprocess_months=1)
    for k, b in enumerate(rows):
        wide.apply(b, k)
        months = narrow.apply(b, k)
    assert _same(wide.staged(), wide.full_rebuild())
    assert min(m for m in months if m) == D(2025, 4, 1)        # January lies outside the window


def test_changed_identity_map_is_refused(spark):
    import pytest
    from lapsekit.sources.feeds import IDENTITY_SCHEMA
    from lapsekit.streaming.incremental import IncrementalEvents
    root = tempfile.mkdtemp(prefix="lapsekit-ident-")
    one = spark.createDataFrame([("cashback", "B1", "U1")], IDENTITY_SCHEMA)
    two = spark.createDataFrame([("cashback", "B1", "U2")], IDENTITY_SCHEMA)
    IncrementalEvents(spark, root, one).apply("cashback", spark.createDataFrame(BATCHES[0], CASHBACK_SCHEMA), 0)
    again = IncrementalEvents(spark, root, one)                # the same map: goes on
    assert {r.unified_user_id for r in again.events().filter("source_event_id = 'T1'").collect()} == {"U1"}
    with pytest.raises(ValueError, match="identity map"):
        IncrementalEvents(spark, root, two)
    new = IncrementalEvents(spark, root, two, accept_new_identity=True)
    assert {r.unified_user_id for r in new.events().filter("source_event_id = 'T1'").collect()} == {"U2"}
    assert _same(new.events(), new.full_rebuild())


def test_own_rows_of_a_batch_are_not_searched(spark, monkeypatch):
    """Rows of a batch are touched by definition: only those of other batches within the window are joined with its keys."""
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-inc-"), "cashback", reprocess_months=2)
    searched, search = [], IncrementalStaging._months_with
    monkeypatch.setattr(IncrementalStaging, "_months_with", lambda *a: searched.append(1) or search(*a))
    row = lambda k, d, st="pending": (k, "B1", d, "M", "N", st, None, Decimal(5))
    batches = [[row("T1", D(2025, 1, 10)), row("T1", D(2025, 1, 10), "approved"), row(None, D(2025, 1, 11)), row("  ", D(2025, 1, 12))],
               [row("T2", D(2025, 6, 10)), row(None, D(2025, 6, 11))],                       # nothing within its window
               [row("T2", D(2025, 7, 1), "approved"), row("T3", D(2025, 6, 3)), row(None, D(2025, 6, 11))]]
    for i, rows in enumerate(batches):
        inc.apply(spark.createDataFrame(rows, CASHBACK_SCHEMA), i)
        assert len(searched) == (i == 2)
        assert _same(inc.staged(), inc.full_rebuild())
    inc.apply(spark.createDataFrame(batches[2][1:], CASHBACK_SCHEMA), 2)      # the retry lacks a row: it goes again
    assert _same(inc.staged(), inc.full_rebuild())
    assert inc.staged().filter("transaction_id = 'T2'").collect()[0].raw_row_count == 1
    assert inc.staged().filter("transaction_id IS NULL").count() == 3         # blanks are a key, trimmed to ''


def test_a_first_batch_sent_again_with_fewer_rows(spark):
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-inc-"), "cashback")
    rows = [("T1", "B1", D(2025, 1, 10), "M", "N", "pending", None, Decimal(5)),
            ("T2", "B1", D(2025, 3, 10), "M", "N", "pending", None, Decimal(5))]
    inc.apply(spark.createDataFrame(rows, CASHBACK_SCHEMA), 0)
    inc.apply(spark.createDataFrame(rows[:1], CASHBACK_SCHEMA), 0)
    assert _same(inc.staged(), inc.full_rebuild()) and inc.staged().count() == 1
