"""Cases at the edges: unobserved periods, dead feeds, bases that fall to zero, overlapping
identity ranges, cut periods, ranges of more than 63 periods."""

import datetime as dt

from lapsekit.functions.periods import periods_of
from lapsekit.operators import cohort, extensions as X
from lapsekit.operators.marts import transitions, transitions_by_bitmap
from lapsekit.spec import ChurnSpec

D = dt.date


def _long(spark, activity, n):
    """Dense rows of one definition from {person: active periods}."""
    rows = [("baseline", u, f"2025Q{i}", D(2025, 1, 1), i, i in on, "x", False)
            for u, on in activity.items() for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "definition_name string, unified_user_id string, quarter_label string, "
                                       "quarter_start_date date, quarter_index long, is_active boolean, "
                                       "activity_mix string, is_active_on_pending_only boolean")


def test_cohort_beyond_the_range_is_not_churn(spark):
    long = _long(spark, {"stay": {3, 4}, "gone": {3}, "never": set()}, 4)
    spec = ChurnSpec(cohort_anchor=3, n_silent=2)
    users = cohort.cohort_users(long, spec)
    assert {r.unified_user_id: r.q3_cohort_status for r in users.collect()} == \
        {"stay": "retained_in_q4", "gone": "not_yet_observed", "never": "not_in_q3_cohort"}
    s = cohort.cohort_summary(users, spec).first()
    assert (s.q3_cohort_users, s.lapsed_in_q4, s.confirmed_churn_users, s.confirmed_churn_rate_of_cohort) == (2, 1, None, None)
    last = ChurnSpec(cohort_anchor=4, n_silent=1)
    users = cohort.cohort_users(long, last)
    assert {r.q4_cohort_status for r in users.collect()} == {"not_yet_observed", "not_in_q4_cohort"}
    assert cohort.cohort_summary(users, last).first().retained_in_q5 is None


def test_dead_feed_alerts_until_it_returns(spark):
    volumes = [0, 10, 11, 0, 0, 0, 0, 0, 0, 9, 10]
    p = spark.createDataFrame([("N", f"20{10 + k // 4}Q{k % 4 + 1}", v) for k, v in enumerate(volumes)],
                              "source string, quarter_label string, transactions long")
    got = [r.is_alert for r in X.feed_continuity(p, 3, 0.5).orderBy("quarter_label").collect()]
    assert got == [False, False, True, True, True, True, True, True, True, True, True]


def test_base_that_falls_to_zero_counts(spark):
    rows = [("2025Q1", v, "baseline", n) for v, n in ((0, 5), (30, 0))] + [("2025Q2", v, "baseline", n) for v, n in ((0, 4), (30, 4))]
    v = spark.createDataFrame(rows, "measured_quarter string, vintage_days long, definition_name string, active_users long")
    r = X.restatement_magnitude(v).first()
    assert (r.measured_quarters, r.mean_abs_restatement_users, r.mean_abs_restatement_rate) == (2, 2.5, 0.5)


def test_overlapping_identity_ranges_give_one_flagged_row(spark):
    m = spark.createDataFrame([("cashback", "B1", "U1", None, D(2025, 3, 31)), ("cashback", "B1", "U2", D(2025, 3, 1), None),
                               ("cashback", "B2", "U3", None, None), ("cashback", "B2", "U3", D(2025, 1, 1), None)],
                              "source_system string, source_user_id string, unified_user_id string, valid_from date, valid_to date")
    ev = spark.createDataFrame([("cashback", f"T{k}", u, d) for k, (u, d) in enumerate([
        ("B1", D(2025, 2, 28)), ("B1", D(2025, 3, 1)), ("B1", D(2025, 3, 31)), ("B1", D(2025, 4, 1)), ("B2", D(2025, 5, 1)),
        ("B9", D(2025, 5, 1)), (None, D(2025, 5, 1)), ("B1", None)])],
        "channel string, source_event_id string, source_user_id string, activity_date date")
    got = {r.source_event_id: (r.unified_user_id, r.has_ambiguous_mapping) for r in X.resolve_identity_scd2(ev, m).collect()}
    assert got == {"T0": ("U1", False), "T1": ("U1", True), "T2": ("U1", True), "T3": ("U2", False), "T4": ("U3", False),
                   "T5": (None, False), "T6": (None, False), "T7": (None, False)}
    o = X.identity_overlaps(m).first()
    assert (o.overlapping_ids, o.overlapping_days) == (1, 31)


def test_cut_periods(spark):
    spec = ChurnSpec(period_start=D(2024, 1, 1), period_end=D(2024, 1, 31), grain="week")
    ps = periods_of(spec.period_start, spec.period_end, "week")
    assert [p.complete for p in ps] == [True, True, True, True, False]
    rows = [("baseline", "U1", p.label, p.start, p.index, p.index in (1, 4), "x", False) for p in ps]
    long = _long(spark, {}, 1).union(spark.createDataFrame(rows, _long(spark, {}, 1).schema))
    assert {r.to_quarter for r in transitions(long, spec).collect()} == {p.label for p in ps[1:4]}


def test_masks_hold_more_than_63_periods(spark):
    spec = ChurnSpec(period_start=D(2024, 1, 1), period_end=D(2026, 1, 4), grain="week")
    ps = periods_of(spec.period_start, spec.period_end, "week")
    assert len(ps) > 100
    on = {"U1": set(range(1, len(ps) + 1, 2)), "U2": {62, 63, 64, 65}, "U3": {len(ps) - 1, len(ps)}, "U4": {61, 62, 124 % len(ps), 63}}
    fact = spark.createDataFrame([(u, p.label, p.start, p.index, p.index in s, p.index in s) for u, s in on.items() for p in ps],
                                 "unified_user_id string, quarter_label string, quarter_start_date date, quarter_index long, "
                                 "is_active_baseline boolean, is_active_approved_only boolean")
    from lapsekit.operators.fact import by_definition
    fact = fact.selectExpr("*", "'x' AS activity_mix", "false AS is_active_on_pending_only")
    a, b = transitions(by_definition(fact, spec), spec), transitions_by_bitmap(fact, spec)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count() == 2 * (len(ps) - 1)
