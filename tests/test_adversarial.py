"""One defect per case (NULL keys, untrimmed ids, unknown vocabularies, conflicting
and stale duplicates, impossible dates, ...) added to a tiny clean extract."""

import datetime as dt
from decimal import Decimal


from lapsekit.plans.layers import Layers
from lapsekit.sources.adapter import RawInputs
from lapsekit.sources.feeds import CASHBACK_SCHEMA, COUPON_SCHEMA, IDENTITY_SCHEMA
from lapsekit.spec import DEFAULT_SPEC

D = dt.date
IDN = [("coupon", "C1001", "U001"), ("cashback", "B2001", "U001"), ("coupon", "C1002", "U002"),
       ("cashback", "B2002", "U002")]
CPN = [("CE1", "C1001", D(2025, 2, 10), "M1", "coupon_copy"), ("CE2", "C1002", D(2025, 5, 10), "M1", "coupon_copy")]
CB = [("CB1", "B2001", D(2025, 5, 10), "M2", "NetA", "approved", D(2025, 6, 4), Decimal("10")),
      ("CB2", "B2002", D(2025, 8, 10), "M2", "NetB", "pending", None, Decimal("20"))]


def build(spark, idn=(), cpn=(), cb=(), spec=DEFAULT_SPEC):
    raw = RawInputs(spark.createDataFrame(IDN + list(idn), IDENTITY_SCHEMA),
                    spark.createDataFrame(CPN + list(cpn), COUPON_SCHEMA),
                    spark.createDataFrame(CB + list(cb), CASHBACK_SCHEMA))
    return Layers(raw, spec)


def dq(L):
    return {r.check_name: r.failing_records for r in L.dq_checks(with_checked_at=False).collect()}


def test_clean_extract_passes(spark):
    d = dq(build(spark))
    assert all(v == 0 for v in d.values()), d


def test_null_event_key_kept_not_collapsed(spark):
    L = build(spark, cpn=[(None, "C1001", D(2025, 2, 11), "M-C01", "coupon_copy")] * 2)
    st = L.stg_coupons.filter("coupon_event_id is null").collect()
    assert len(st) == 2 and all(r.raw_row_count == 1 and not r.was_duplicated_in_raw for r in st)
    assert dq(L)["raw_duplicate_coupon_event_ids"] == 0


def test_null_person_not_in_spine(spark):
    L = build(spark, idn=[("coupon", "C9001", None)])
    d = dq(L)
    assert d["identity_map_null_keys"] == 1 and d["fct_row_count_mismatch"] == 0
    assert L.fact.filter("unified_user_id is null").count() == 0


def test_null_and_unknown_system(spark):
    d = dq(build(spark, idn=[(None, "C9002", "U001"), ("app", "A1", "U001")]))
    assert d["identity_map_null_keys"] == 1 and d["identity_map_unknown_source_system"] == 2


def test_ambiguous_id_excluded_everywhere(spark):
    L = build(spark, idn=[("cashback", "B2001", "U900")])
    assert dq(L)["identity_map_ambiguous_source_id"] == 1
    ev = L.events.filter("source_event_id = 'CB1'").collect()[0]
    assert ev.has_ambiguous_mapping and not ev.is_in_scope
    asof = L.activity_as_of(D(2026, 1, 1)).filter("quarter_label = '2025Q2'").collect()
    assert [r.unified_user_id for r in asof] == ["U002"]


def test_untrimmed_keys_resolve(spark):
    L = build(spark, cpn=[("CE9", "\tC1001 ", D(2025, 8, 1), "M1", " Coupon_Copy")],
              idn=[(" Coupon", "C1003", "U003")])
    ev = L.events.filter("source_event_id = 'CE9'").collect()[0]
    assert ev.unified_user_id == "U001" and ev.counts_as_activity_baseline
    assert L.stg_identity.filter("source_system = 'coupon' and source_user_id = 'C1003'").count() == 1
    assert ("CE9",) in [(r.record_id,) for r in L.trace("U001", 2).collect()]


def test_null_and_out_of_period_dates(spark):
    L = build(spark, cpn=[("CE91", "C1001", None, "M1", "coupon_copy"),
                          ("CE92", "C1001", D(2024, 12, 31), "M1", "coupon_copy")])
    d = dq(L)
    assert d["null_activity_date"] == 1 and d["activity_outside_analysis_period"] == 2
    reasons = {r.source_event_id: r.exclusion_reason for r in L.excluded_events.collect()}
    assert reasons == {"CE91": "activity date missing", "CE92": "activity date outside 2025"}


def test_period_edges(spark):
    L = build(spark, cpn=[(f"E{i}", "C1001", d, "M1", "coupon_copy") for i, d in
                          enumerate([D(2025, 1, 1), D(2025, 3, 31), D(2025, 4, 1), D(2025, 12, 31)])])
    got = {r.source_event_id: r.quarter_label for r in L.events.filter("source_event_id like 'E%'").collect()}
    assert got == {"E0": "2025Q1", "E1": "2025Q1", "E2": "2025Q2", "E3": "2025Q4"}


def test_event_type_and_status_vocabulary(spark):
    L = build(spark, cpn=[("CE7", "C1001", D(2025, 8, 1), "M1", None), ("CE8", "C1001", D(2025, 8, 1), "M1", "coupon_view")],
              cb=[("CB7", "B2001", D(2025, 8, 1), "M2", "NetA", "validated", D(2025, 8, 20), Decimal(1)),
                  ("CB8", "B2001", D(2025, 8, 2), "M2", "NetA", None, D(2025, 8, 20), Decimal(1))])
    d = dq(L)
    assert d["unexpected_coupon_event_type"] == 2 and d["unexpected_cashback_status"] == 2
    q3 = L.fact.filter("unified_user_id = 'U001' and quarter_label = '2025Q3'").collect()[0]
    assert not q3.is_active_baseline


def test_conflicting_duplicate_is_deterministic(spark):
    dup = ("CB1", "B2001", D(2025, 5, 10), "M2", "NetA", "approved", D(2025, 6, 4), Decimal("99"))
    kept = set()
    for parts in (1, 3, 8):
        L = build(spark, cb=[dup])
        L.raw.cashback = L.raw.cashback.repartition(parts)
        r = L.stg_cashback.filter("transaction_id = 'CB1'").collect()[0]
        kept.add(r.amount_sar)
        assert r.has_conflicting_duplicate and r.raw_row_count == 2
    assert kept == {Decimal("10.000000000")}
    assert dq(build(spark, cb=[dup]))["duplicate_ids_with_conflicting_payload"] == 1


def test_stale_pending_duplicate_keep_modes(spark):
    rows = [("CBX", "B2001", D(2025, 7, 1), "M2", "NetA", "pending", None, Decimal(5)),
            ("CBX", "B2001", D(2025, 7, 1), "M2", "NetA", "approved", D(2025, 7, 20), Decimal(5))]
    first = build(spark, cb=rows).stg_cashback.filter("transaction_id = 'CBX'").collect()[0]
    latest = build(spark, cb=rows, spec=DEFAULT_SPEC.with_(keep="latest")).stg_cashback.filter(
        "transaction_id = 'CBX'").collect()[0]
    assert first.status == "pending" and latest.status == "approved"


def test_null_inside_payload_is_conflict(spark):
    rows = [("CBY", "B2001", D(2025, 7, 1), "M2", "NetA", "approved", D(2025, 7, 5), Decimal(5)),
            ("CBY", "B2001", D(2025, 7, 1), None, "NetA", "approved", D(2025, 7, 5), Decimal(5))]
    r = build(spark, cb=rows).stg_cashback.filter("transaction_id = 'CBY'").collect()[0]
    assert r.has_conflicting_duplicate and r.merchant_id is None  # NULL sorts first


def test_date_order_checks(spark):
    d = dq(build(spark, cb=[
        ("CB10", "B2001", D(2025, 7, 10), "M2", "NetA", "approved", D(2025, 7, 1), Decimal(1)),
        ("CB11", "B2001", D(2025, 7, 10), "M2", "NetA", "rejected", None, Decimal(1)),
        ("CB12", "B2001", D(2025, 7, 10), "M2", "NetA", "pending", D(2025, 7, 12), Decimal(1))]))
    assert (d["status_decided_before_purchase"], d["settled_txn_missing_decision_date"],
            d["pending_txn_with_decision_date"]) == (1, 1, 1)


def test_cross_source_duplicate(spark):
    L = build(spark, cb=[("CB20", "B2001", D(2025, 5, 10), "M2", "NetZ", "approved", D(2025, 6, 4), Decimal("10"))])
    s = L.cross_source_duplicates.collect()
    assert len(s) == 1 and s[0].sources == ["NetA", "NetZ"] and s[0].transaction_count == 2
    assert sorted(r.transaction_id for r in L.cross_source_members.collect()) == ["CB1", "CB20"]
    base = {r.quarter_label: r.active_users for r in L.active_base.filter("definition_name='baseline'").collect()}
    assert base["2025Q2"] == 2


def test_silent_feed_dense_profile(spark):
    L = build(spark, cb=[("CB30", "B2001", D(2025, 2, 1), "M2", "NetA", "approved", D(2025, 2, 5), Decimal(1)),
                         ("CB31", "B2001", D(2025, 11, 1), "M2", "NetA", "approved", D(2025, 11, 5), Decimal(1))])
    p = {r.quarter_label: r for r in L.source_profile.filter("source = 'NetA'").collect()}
    assert [p[f"2025Q{i}"].transactions for i in range(1, 5)] == [1, 1, 0, 1]
    assert p["2025Q3"].prior_quarter_transactions == 1 and p["2025Q4"].prior_quarter_transactions == 0


def test_zero_denominators(spark):
    from pyspark.sql import functions as F
    L = build(spark)
    L.raw.cashback = L.raw.cashback.filter(F.lit(False))
    pe = L.pending_exposure.collect()
    assert len(pe) == 4 and all(r.pending_transaction_rate is None for r in pe)
    assert L.approval_maturity.collect() == []          # nothing decided: no rows, no error
    t = {r.definition_name + r.from_quarter: r for r in L.transitions.collect()}
    assert t["baseline2025Q1"].active_base == 1 and t["baseline2025Q3"].next_quarter_churn_rate is None
