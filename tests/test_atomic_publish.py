"""Commits of the versioned store: all tables at once or none, and recovery of a broken batch."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from lapsekit.sources.feeds import CASHBACK_SCHEMA, COUPON_SCHEMA, IDENTITY_SCHEMA
from lapsekit.sources.versions import ConflictError, Transaction, VersionedStore
from lapsekit.streaming.incremental import IncrementalEvents, IncrementalStaging

D = dt.date


def same(a, b):
    assert a.columns == b.columns
    return sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def cash(spark, *rows):
    return spark.createDataFrame([(t, u, d, "M", "N", s, x, Decimal(5)) for t, u, d, s, x in rows], CASHBACK_SCHEMA)


FIRST = [("T1", "B1", D(2025, 1, 10), "pending", None), ("T2", "B2", D(2025, 1, 12), "approved", D(2025, 1, 20)),
         ("T9", "B3", D(2025, 3, 2), "approved", D(2025, 3, 4))]
SECOND = [("T3", "B1", D(2025, 1, 30), "approved", D(2025, 2, 3)), ("T1", "B1", D(2025, 1, 10), "approved", D(2025, 2, 2))]


class Lost(RuntimeError):
    """The driver is gone."""


@pytest.mark.parametrize("at", ["stg_cashback", "person_activity", "commit"])
def test_a_writer_lost_at_any_moment_leaves_the_old_state_and_its_retry_the_full_build(spark, monkeypatch, at):
    idn = spark.createDataFrame([("cashback", f"B{i}", f"U{i}") for i in range(1, 4)], IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, tempfile.mkdtemp(prefix="lapsekit-lost-"), idn, marts=True)
    model.apply("cashback", cash(spark, *FIRST), 0)
    before = [r for r in model.events().collect()]
    write, commit = Transaction.write, Transaction._commit

    def lose_write(self, df, table, *a, **k):
        if table == at:
            df.limit(1).write.parquet(self.store.folder(table, f"{self.id}-half"))     # some files are there
            raise Lost
        return write(self, df, table, *a, **k)

    def lose_commit(self):
        raise Lost
    monkeypatch.setattr(Transaction, "write", lose_write)
    if at == "commit":
        monkeypatch.setattr(Transaction, "_commit", lose_commit)
    with pytest.raises(Lost):
        model.apply("cashback", cash(spark, *SECOND), 1)
    monkeypatch.setattr(Transaction, "write", write)
    monkeypatch.setattr(Transaction, "_commit", commit)
    again = IncrementalEvents(spark, model.store.root, idn, marts=True)             # a new driver
    assert sorted(again.events().collect(), key=str) == sorted(before, key=str)
    again.apply("cashback", cash(spark, *SECOND), 1)
    assert same(again.cashback.staged(), again.cashback.full_rebuild())
    assert {r.transaction_id for r in again.cashback.staged().collect()} == {"T1", "T2", "T3", "T9"}
    assert same(again.events(), again.full_rebuild())


def test_only_month_of_the_store_is_lost(spark, monkeypatch):
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-one-"), "cashback")
    commit = Transaction._commit
    monkeypatch.setattr(Transaction, "_commit", lambda self: (_ for _ in ()).throw(Lost()))
    with pytest.raises(Lost):
        inc.apply(cash(spark, *FIRST[:2]), 0)
    assert inc.staged().count() == 0 and inc.raw().count() == 0
    monkeypatch.setattr(Transaction, "_commit", commit)
    inc.apply(cash(spark, *FIRST[:2]), 0)
    assert inc.staged().count() == 2


def test_versions_conflicts_and_vacuum(spark):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="lapsekit-ver-"))
    schema = spark.createDataFrame([], "v int, k string").schema
    for i, rows in enumerate([[(1, "a"), (2, "b")], [(3, "b")], [(4, "c x")]]):
        with store.transaction() as tx:
            tx.write(spark.createDataFrame(rows, schema), "t", ("k",), (lambda p: p["k"] == "a") if i == 2 else None)
    read = lambda v=None: sorted(map(tuple, store.read("t", schema, ("k",), store.snapshot(v)).collect()))
    assert read() == [(3, "b"), (4, "c x")] and read(1) == [(1, "a"), (2, "b")] and read(2) == [(1, "a"), (3, "b")]
    with pytest.raises(ConflictError):
        with store.transaction() as tx:
            other = VersionedStore(spark, store.root)
            with other.transaction() as t2:                                        # as another process would
                t2.write(spark.createDataFrame([(9, "z")], schema), "t", ("k",))
            tx.write(spark.createDataFrame([(8, "y")], schema), "t", ("k",))
    assert read() == [(3, "b"), (4, "c x"), (9, "z")]
    with store.transaction():                                                      # writes nothing: no new version
        pass
    assert store.versions() == [1, 2, 3, 4]
    assert store.vacuum(keep=1) == 2                                               # version 1's folder, and the refused one
    assert store.versions() == [4] and read() == [(3, "b"), (4, "c x"), (9, "z")]
    assert [n for n in os.listdir(os.path.join(store.root, "manifests")) if n.endswith(".draft")] == []


def test_compacted_raw_batches_change_nothing(spark):
    inc = IncrementalStaging(spark, tempfile.mkdtemp(prefix="lapsekit-compact-"), "cashback")
    for k, rows in enumerate([FIRST, SECOND, FIRST, [("T7", "B1", None, "pending", None)]]):
        inc.apply(cash(spark, *rows), k, "s")
    inc.apply(cash(spark, *SECOND), 0, "other")
    rows = inc.raw().count()
    inc.compact_raw()
    names = {p.split("/")[0] for p in inc.store.snapshot().partitions("raw_cashback")}
    assert names == {"_batch=compacted", "_batch=s-3", "_batch=other-0"} and inc.raw().count() == rows
    inc.apply(cash(spark, ("T1", "B1", D(2025, 1, 10), "approved", D(2025, 2, 2))), 3, "s")   # replay with other rows
    inc.apply(cash(spark, ("T2", "B2", D(2025, 1, 12), "approved", D(2025, 1, 20))), 4, "s")
    assert same(inc.staged(), inc.full_rebuild())


def full_marts(model):
    from lapsekit.operators.cohort import cohort_summary, cohort_users
    from lapsekit.operators.fact import by_definition, user_period_activity
    from lapsekit.operators.marts import active_base, transitions
    fact = user_period_activity(model.full_rebuild(), model.identity, model.spec)
    long = by_definition(fact, model.spec)
    return {"fact": fact, "active_base": active_base(long), "transitions": transitions(long, model.spec),
            "cohort_summary": cohort_summary(cohort_users(long, model.spec), model.spec)}


def test_marts_follow_every_batch(spark):
    idn = spark.createDataFrame([("cashback", f"B{i}", f"U{i}") for i in range(1, 7)]
                                + [("coupon", f"C{i}", f"U{i}") for i in range(1, 9)] + [("cashback", "B1", "U9")], IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, tempfile.mkdtemp(prefix="lapsekit-marts-"), idn, marts=True)
    check = lambda: all(same(getattr(model.marts, n)(), df) for n, df in full_marts(model).items())
    assert check()                                                    # all persons, no activity yet
    coupon = lambda *rows: spark.createDataFrame([(e, u, d, "M", t) for e, u, d, t in rows], COUPON_SCHEMA)
    batches = [
        ("cashback", cash(spark, ("T1", "B2", D(2025, 1, 10), "pending", None), ("T2", "B3", D(2025, 2, 12), "approved", D(2025, 3, 1)),
                          ("T3", "B3", D(2025, 8, 1), "approved", D(2025, 8, 2)), ("T4", "B1", D(2025, 1, 3), "approved", None))),
        ("coupon", coupon(("E1", "C2", D(2025, 5, 1), "coupon_copy"), ("E2", "C8", D(2025, 2, 2), "coupon_copy"),
                          ("E3", "C3", D(2025, 3, 3), "coupon_view"))),
        # a decision that takes activity away, a row that moves to another period, a date that goes, one beyond the range
        ("cashback", cash(spark, ("T1", "B2", D(2025, 1, 10), "rejected", D(2025, 1, 9)), ("T3", "B3", D(2025, 6, 30), "approved", D(2025, 8, 2)),
                          ("T5", "B5", D(2026, 1, 1), "approved", None), ("T6", "B6", None, "approved", None))),
        ("coupon", coupon(("E1", "C2", D(2025, 5, 1), "coupon_copy"), (None, "C4", D(2025, 12, 31), "coupon_copy"))),
        ("cashback", cash(spark, ("T2", "B3", D(2025, 2, 12), "approved", D(2025, 3, 1)))),
    ]
    for k, (feed, rows) in enumerate(batches):
        model.apply(feed, rows, k)
        assert check(), k
    model.apply("cashback", cash(spark, ("T8", "B4", D(2025, 9, 9), "approved", None)), 2)   # batch 2 again, with other rows
    assert check()
    two = spark.createDataFrame([("cashback", "B3", "U1"), ("coupon", "C2", "U1")], IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, model.store.root, two, accept_new_identity=True, marts=True)
    assert check()


def test_a_batch_writes_only_the_buckets_of_its_persons(spark):
    idn = spark.createDataFrame([("cashback", f"B{i}", f"U{i}") for i in range(200)], IDENTITY_SCHEMA)
    model = IncrementalEvents(spark, tempfile.mkdtemp(prefix="lapsekit-bucket-"), idn, marts=True)
    model.apply("cashback", cash(spark, *[(f"T{i}", f"B{i}", D(2025, 1 + i % 12, 5), "approved", None) for i in range(200)]), 0)
    before = model.store.snapshot().tables["person_activity"]
    model.apply("cashback", cash(spark, ("T900", "B7", D(2025, 4, 4), "approved", None)), 1)
    after = model.store.snapshot().tables["person_activity"]
    assert len(before) > 40 and sum(before.get(p) != c for p, c in after.items()) == 1
    assert same(model.marts.fact(), full_marts(model)["fact"])
