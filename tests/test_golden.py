"""The published results of the three-feed extract, recomputed end to end."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from support import rows


def test_row_counts(golden):
    L = golden
    assert (L.raw.identity.count(), L.raw.coupons.count(), L.raw.cashback.count()) == (132, 88, 99)
    assert (L.stg_identity.count(), L.stg_coupons.count(), L.stg_cashback.count()) == (132, 87, 98)
    assert L.events.count() == 185
    assert L.events.filter("is_in_scope").count() == 184
    assert L.fact.count() == 264
    assert L.fact.select("unified_user_id").distinct().count() == 66


def test_active_base(golden):
    got = rows(golden.active_base, "definition_name", "quarter_index", "active_users", "active_coupon_only",
               "active_cashback_only", "active_both_channels", "active_on_pending_only")
    assert got == sorted([
        ("baseline", 1, 45, 20, 21, 4, 0), ("baseline", 2, 37, 16, 17, 4, 1),
        ("baseline", 3, 38, 16, 18, 4, 1), ("baseline", 4, 46, 19, 23, 4, 3),
        ("approved_only", 1, 45, 20, 21, 4, 0), ("approved_only", 2, 36, 16, 16, 4, 0),
        ("approved_only", 3, 37, 16, 17, 4, 0), ("approved_only", 4, 43, 19, 20, 4, 0)])


def test_transitions(golden):
    got = rows(golden.transitions, "definition_name", "from_quarter", "active_base", "retained_users",
               "churned_users", "next_quarter_churn_rate", "next_quarter_retention_rate", "new_or_returning_users")
    assert got == sorted([
        ("baseline", "2025Q1", 45, 26, 19, 0.4222, 0.5778, 11), ("baseline", "2025Q2", 37, 26, 11, 0.2973, 0.7027, 12),
        ("baseline", "2025Q3", 38, 36, 2, 0.0526, 0.9474, 10),
        ("approved_only", "2025Q1", 45, 25, 20, 0.4444, 0.5556, 11),
        ("approved_only", "2025Q2", 36, 24, 12, 0.3333, 0.6667, 13),
        ("approved_only", "2025Q3", 37, 34, 3, 0.0811, 0.9189, 9)])
    sens = rows(golden.sensitivity, "from_quarter", "churn_rate_delta_pp")
    assert sens == [("2025Q1", 0.0222), ("2025Q2", 0.036), ("2025Q3", 0.0285)]


def test_cohort(golden):
    s = {r["definition_name"]: r for r in golden.cohort_summary.collect()}
    b, a = s["baseline"], s["approved_only"]
    assert (b.q1_cohort_users, b.retained_in_q2, b.lapsed_in_q2, b.confirmed_churn_users,
            b.reactivated_in_q3_users) == (45, 26, 19, 12, 7)
    assert (b.confirmed_churn_rate_of_cohort, b.reactivation_rate_of_lapsed_q2, b.reactivated_share_of_cohort) == \
        (0.2667, 0.3684, 0.1556)
    assert (a.lapsed_in_q2, a.confirmed_churn_users, a.reactivated_in_q3_users, a.reactivation_rate_of_lapsed_q2) == \
        (20, 12, 8, 0.4)
    pats = dict(((r[0], r[1]), r[2]) for r in golden.cohort_users.groupBy("definition_name", "activity_pattern")
                .count().collect())
    assert pats[("baseline", "1111")] == 19 and pats[("approved_only", "0000")] == 1
    assert pats[("approved_only", "1011")] == 7


def test_disagreements_and_trace(golden):
    got = rows(golden.disagreements, "quarter_label", "unified_user_id")
    assert got == [("2025Q2", "U055"), ("2025Q3", "U054"), ("2025Q4", "U053"), ("2025Q4", "U056"), ("2025Q4", "U066")]
    pat = dict(rows(golden.trace("U055", 5), "definition_name", "activity_pattern"))
    assert pat == {"baseline": "1111", "approved_only": "1011"}
    contrib = rows(golden.trace("U055", 6).filter("from_quarter = '2025Q1'"), "definition_name", "contributes_as")
    assert contrib == [("approved_only", "churned"), ("baseline", "retained")]
    raw = rows(golden.trace("U055", 2), "record_id")
    assert ("CB0070",) in raw and ("CE0067",) in raw


def test_pending_exposure(golden):
    got = rows(golden.pending_exposure, "quarter_label", "active_users_baseline", "active_users_approved_only",
               "users_active_only_via_pending", "active_users_with_any_pending", "share_of_active_base_at_risk",
               "cashback_transactions", "pending_transactions", "pending_transaction_rate", "pending_amount_sar",
               "gross_amount_sar")
    assert got == [
        ("2025Q1", 45, 45, 0, 0, 0.0, 25, 0, 0.0, Decimal("0E-9"), Decimal("2185.000000000")),
        ("2025Q2", 37, 36, 1, 1, 0.027, 24, 1, 0.0417, Decimal("55.000000000"), Decimal("1927.000000000")),
        ("2025Q3", 38, 37, 1, 1, 0.0263, 22, 1, 0.0455, Decimal("48.000000000"), Decimal("1843.000000000")),
        ("2025Q4", 46, 43, 3, 3, 0.0652, 27, 3, 0.1111, Decimal("235.000000000"), Decimal("2213.000000000"))]


def test_maturity(golden):
    m = {r["source"]: r for r in golden.approval_maturity.collect()}
    allr = m["ALL SOURCES"]
    assert (allr.decided_transactions, allr.eventual_approval_rate, allr.decided_within_30d, allr.decided_within_45d,
            allr.decided_within_60d, allr.decided_within_90d) == (93, 0.9785, 0.957, 0.9677, 0.9677, 1.0)
    assert (allr.p50_days_to_decision, allr.p90_days_to_decision, allr.max_days_to_decision) == (25, 25, 76)
    assert (m["ClickHarbor"].decided_transactions, m["ClickHarbor"].max_days_to_decision) == (15, 76)
    assert m["NovaLink Affiliates"].eventual_approval_rate == 0.9375
    assert golden.maturity_curve.count() == 28


def test_source_profile(golden):
    p = {(r.source, r.quarter_label): r for r in golden.source_profile.collect()}
    assert [p[("ClickHarbor", f"2025Q{i}")].transactions for i in range(1, 5)] == [8, 3, 3, 2]
    assert [p[("Orbit Affiliates", f"2025Q{i}")].transactions for i in range(1, 5)] == [3, 4, 2, 7]
    assert p[("RewardBridge", "2025Q2")].rows_with_unmapped_user == 1
    assert p[("ClickHarbor", "2025Q1")].decisions_landing_in_later_quarter == 1
    assert p[("NovaLink Affiliates", "2025Q4")].median_days_to_decision is None
    assert p[("ClickHarbor", "2025Q2")].prior_quarter_transactions == 8
    assert golden.cross_source_duplicates.count() == 0


def test_vintages(golden):
    v = rows(golden.transition_by_vintage, "definition_name", "vintage_days", "active_base", "retained_users",
             "churned_users")
    assert v == sorted([(d, k, *x) for d, x in [("baseline", (37, 26, 11)), ("approved_only", (36, 24, 12))]
                        for k in (0, 30, 45, 90)])
    ab = {(r.definition_name, r.measured_quarter, r.vintage_days): r.active_users
          for r in golden.active_base_by_vintage.collect()}
    assert len(ab) == 32
    assert [ab[("approved_only", "2025Q1", k)] for k in (0, 30, 45, 90)] == [43, 45, 45, 45]
    assert [ab[("approved_only", "2025Q3", k)] for k in (0, 30, 45, 90)] == [36, 37, 37, 37]
    assert [ab[("baseline", q, 0)] for q in ("2025Q1", "2025Q2", "2025Q3", "2025Q4")] == [45, 37, 38, 46]


def test_dq_and_gate(golden):
    dq = {r.check_name: r for r in golden.dq_checks().collect()}
    assert len(dq) == 21
    failing = {k: v.failing_records for k, v in dq.items() if v.failing_records}
    assert failing == {"raw_duplicate_coupon_event_ids": 1, "raw_duplicate_transaction_ids": 1,
                       "unmapped_cashback_user_ids": 1}
    assert dq["unmapped_cashback_user_ids"].severity == "error" and dq["unmapped_cashback_user_ids"].check_status == "FAIL"
    g = golden.publish_gate().collect()[0]
    assert (g.blocking_failures, g.warnings, g.can_publish) == (1, 2, False)
    assert g.blocking_checks == ["unmapped_cashback_user_ids"]
    ex = golden.excluded_events.collect()
    assert len(ex) == 1 and ex[0].exclusion_reason == "source id not in identity map"


def test_reporting(golden):
    s = golden.report_summary
    assert s.count() == 104
    v = s.filter((F.col("section_order") == 2) & (F.col("definition_name") == "baseline")
                 & (F.col("period") == "2025Q1 -> 2025Q2") & (F.col("metric") == "next_quarter_churn_rate")).collect()
    assert v[0].value == Decimal("0.422200000")
    assert golden.headline.count() == 3
    assert golden.cohort_funnel.count() == 10
    led = rows(golden.cardinality_ledger, "step_order", "rows_in", "rows_out")
    assert led == [(1, 88, 87), (2, 99, 98), (3, 132, 132), (4, 185, 185), (5, 185, 184), (6, 184, 264)]


def test_as_of_far_future_equals_fact(golden):
    far = golden.activity_as_of(dt.date(2030, 1, 1))
    fa = golden.fact.filter("is_active_baseline").select("unified_user_id", "quarter_label")
    aa = far.filter("is_active_baseline").select("unified_user_id", "quarter_label")
    assert fa.exceptAll(aa).count() == 0 and aa.exceptAll(fa).count() == 0
