"""Layer 6b: graded data-quality assertions (M16 = K01..K21), excluded-event
detail (M17) and the publish gate (M30).

Every input table is aggregated ONCE (all checks on that table are columns of a
single global aggregate, partial-aggregated in the map tasks) and the results
are reshaped into rows with ``stack``; the reconciliation checks compare small
marts. Comparisons are NULL-safe: a NULL system or event type is an unexpected
value, not a skipped row.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.periods import periods_of
from lapsekit.functions.text import norm_key
from lapsekit.operators.events import activity_col
from lapsekit.operators.fact import active_col
from lapsekit.spec import CASHBACK, COUPON, ChurnSpec, DEFAULT_SPEC

# --- fixed values: check catalogue (name, severity, description) ------------
CHECKS = [
    ("raw_duplicate_coupon_event_ids", "warn", "Repeated coupon_event_id rows removed by staging"),
    ("raw_duplicate_transaction_ids", "warn", "Repeated transaction_id rows removed by staging"),
    ("duplicate_ids_with_conflicting_payload", "error",
     "Same id seen twice with different content - integration bug, not a replay"),
    ("identity_map_ambiguous_source_id", "error", "One source id resolving to more than one unified_user_id"),
    ("identity_map_null_keys", "error", "Identity map row with a missing key column"),
    ("identity_map_unknown_source_system", "error",
     "source_system outside coupon/cashback would never join to an event"),
    ("unmapped_coupon_user_ids", "error", "Coupon source ids absent from the identity map - activity is dropped"),
    ("unmapped_cashback_user_ids", "error",
     "Cashback source ids absent from the identity map - activity is dropped"),
    ("unexpected_coupon_event_type", "warn", "Coupon events that are not coupon_copy and therefore not activity"),
    ("unexpected_cashback_status", "error",
     "Status value outside approved/pending/rejected/cancelled - eligibility undefined"),
    ("activity_outside_analysis_period", "warn", "Events dated outside the analysis period"),
    ("null_activity_date", "error", "Event with no usable activity date"),
    ("status_decided_before_purchase", "error",
     "status_updated_date earlier than purchase_date - impossible workflow order"),
    ("settled_txn_missing_decision_date", "warn",
     "Decided transaction with no decision date - breaks the maturity model"),
    ("pending_txn_with_decision_date", "warn", "Pending transaction that already has a decision date"),
    ("fct_grain_not_unique", "error", "fct_user_quarter_activity must be one row per user per quarter"),
    ("fct_row_count_mismatch", "error", "Spine must be complete: users x quarters"),
    ("approved_only_active_exceeds_baseline", "error",
     "approved_only actives must be a subset of baseline actives"),
    ("transitions_do_not_reconcile", "error", "retained + churned must equal the active base"),
    ("q1_cohort_does_not_reconcile", "error",
     "confirmed churn + reactivated must equal the users who lapsed in Q2"),
    ("active_base_disagrees_with_event_recount", "error",
     "Fact-table active base recounted independently from the event stream"),
]
# ---------------------------------------------------------------------------


def _rows(agg: DataFrame, named: dict[str, Column]) -> DataFrame:
    """One-row aggregate -> (check_name, failing_records) rows via stack."""
    parts = []
    for name, expr in named.items():
        parts += [F.lit(name), expr.cast("long")]
    return agg.select(F.stack(F.lit(len(named)), *parts).alias("check_name", "failing_records"))


def dq_failures(layers, spec: ChurnSpec | None = None) -> DataFrame:
    """(check_name, failing_records) for all 21 assertions."""
    spec = spec or layers.spec
    cp, cb, idn, ev, fct = (layers.stg_coupons, layers.stg_cashback, layers.stg_identity,
                            layers.events, layers.fact)
    prim, strict = spec.primary, spec.strict

    def loaded(df: DataFrame, key: str):                     # rows of the raw table, not staging's own counter
        return df.select(F.count(norm_key(key))).scalar()

    coupons = cp.agg(
        (loaded(layers.raw.coupons, "coupon_event_id") - F.count("coupon_event_id")).alias("c_dup"),
        F.count_if(F.col("has_conflicting_duplicate")).alias("c_conf"),
        F.count_if(~F.coalesce(F.col("event_type").isin(*spec.eligible_event_types), F.lit(False)))
        .alias("c_type"))
    cash = cb.agg(
        (loaded(layers.raw.cashback, "transaction_id") - F.count("transaction_id")).alias("b_dup"),
        F.count_if(F.col("has_conflicting_duplicate")).alias("b_conf"),
        F.count_if(F.col("status_class") == "unknown").alias("b_unknown"),
        F.count_if(F.col("days_to_status_decision") < 0).alias("b_before"),
        F.count_if(F.col("status_class").isin("settled", "failed") & F.col("status_updated_date").isNull())
        .alias("b_nodate"),
        F.count_if((F.col("status") == "pending") & F.col("status_updated_date").isNotNull()).alias("b_pdate"))
    ident = idn.agg(
        F.count_if(F.col("has_ambiguous_mapping")).alias("identity_map_ambiguous_source_id"),
        F.count_if(F.col("source_system").isNull() | F.col("source_user_id").isNull()
                   | F.col("unified_user_id").isNull()).alias("identity_map_null_keys"),
        F.count_if(~F.coalesce(F.col("source_system").isin(*spec.source_systems), F.lit(False)))
        .alias("identity_map_unknown_source_system"))
    lost = (ev.filter(F.col("is_unmapped_user") & F.col("source_user_id").isNotNull())
            .select("channel", "source_user_id").distinct()
            .agg(F.count_if(F.col("channel") == COUPON).alias("unmapped_coupon_user_ids"),
                 F.count_if(F.col("channel") == CASHBACK).alias("unmapped_cashback_user_ids")))
    events = ev.agg(
        F.count_if(~F.col("is_in_analysis_period")).alias("activity_outside_analysis_period"),
        F.count_if(F.col("activity_date").isNull()).alias("null_activity_date"))
    n_periods = len(periods_of(spec.period_start, spec.period_end, spec.grain))
    persons = (idn.filter(~F.col("has_ambiguous_mapping"))
               .select(F.count_distinct("unified_user_id")).scalar())
    fact = fct.agg(
        F.abs(F.count(F.lit(1)) - persons * F.lit(n_periods)).alias("fct_row_count_mismatch"),
        F.count_if(F.col(active_col(strict)) & ~F.col(active_col(prim))).alias("approved_only_active_exceeds_baseline"))
    grain = (fct.groupBy("unified_user_id", "quarter_label").count().filter(F.col("count") > 1)
             .agg(F.count(F.lit(1)).alias("fct_grain_not_unique")))
    trans = layers.transitions.agg(
        F.count_if(F.col("retained_users") + F.col("churned_users") != F.col("active_base"))
        .alias("transitions_do_not_reconcile"))
    summ = layers.cohort_summary
    a = spec.cohort_anchor
    react = [c for c in summ.columns if c.startswith("reactivated_in_") and c.endswith("_users")][0]
    cohort = summ.agg(
        F.count_if(F.col("confirmed_churn_users") + F.col(react) != F.col(f"lapsed_in_q{a + 1}"))
        .alias("q1_cohort_does_not_reconcile"))
    recount = (ev.filter(F.col("is_in_scope") & F.col(activity_col(prim)))
               .groupBy("quarter_label").agg(F.count_distinct("unified_user_id").alias("n")))
    base = layers.active_base.filter(F.col("definition_name") == prim.name)
    recon = (base.join(recount, "quarter_label", "left")
             .agg(F.count_if(F.col("active_users") != F.coalesce(F.col("n"), F.lit(0)))
                  .alias("active_base_disagrees_with_event_recount")))

    parts = [
        _rows(coupons, {"raw_duplicate_coupon_event_ids": F.coalesce(F.col("c_dup"), F.lit(0)),
                        "unexpected_coupon_event_type": F.col("c_type")}),
        _rows(cash, {"raw_duplicate_transaction_ids": F.coalesce(F.col("b_dup"), F.lit(0)),
                     "unexpected_cashback_status": F.col("b_unknown"),
                     "status_decided_before_purchase": F.col("b_before"),
                     "settled_txn_missing_decision_date": F.col("b_nodate"),
                     "pending_txn_with_decision_date": F.col("b_pdate")}),
        _rows(coupons.select((F.col("c_conf") + cash.select("b_conf").scalar())
                             .alias("duplicate_ids_with_conflicting_payload")),
              {"duplicate_ids_with_conflicting_payload": F.col("duplicate_ids_with_conflicting_payload")}),
        _rows(ident, {c: F.col(c) for c in ident.columns}),
        _rows(lost, {c: F.col(c) for c in lost.columns}),
        _rows(events, {c: F.col(c) for c in events.columns}),
        _rows(fact, {c: F.col(c) for c in fact.columns}),
        _rows(grain, {"fct_grain_not_unique": F.col("fct_grain_not_unique")}),
        _rows(trans, {"transitions_do_not_reconcile": F.col("transitions_do_not_reconcile")}),
        _rows(cohort, {"q1_cohort_does_not_reconcile": F.col("q1_cohort_does_not_reconcile")}),
        _rows(recon, {"active_base_disagrees_with_event_recount":
                      F.col("active_base_disagrees_with_event_recount")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_checks(layers, spec: ChurnSpec | None = None, tolerance: dict | None = None,
              with_checked_at: bool = True) -> DataFrame:
    """check_name, severity, check_description, failing_records, tolerance,
    check_status (PASS when failing_records <= tolerance), checked_at."""
    spec = spec or layers.spec
    tol = tolerance or {}
    span = f"{spec.period_start.isoformat()}..{spec.period_end.isoformat()}"
    meta = [(n, s, f"Events dated outside {span}" if n == "activity_outside_analysis_period" else d)
            for n, s, d in CHECKS]
    failures = dq_failures(layers, spec)
    sev = F.create_map(*[F.lit(x) for n, s, _ in meta for x in (n, s)])
    desc = F.create_map(*[F.lit(x) for n, _, d in meta for x in (n, d)])
    tmap = F.create_map(*[F.lit(x) for n, _, _ in meta for x in (n, int(tol.get(n, 0)))])
    out = failures.select(
        "check_name", sev[F.col("check_name")].alias("severity"),
        desc[F.col("check_name")].alias("check_description"),
        F.col("failing_records"), tmap[F.col("check_name")].cast("long").alias("tolerance"))
    out = out.withColumn("check_status", F.when(F.col("failing_records") <= F.col("tolerance"), "PASS")
                         .otherwise("FAIL"))
    if with_checked_at:
        out = out.withColumn("checked_at", F.current_timestamp())
    return out


def _whole_year(spec: ChurnSpec) -> bool:
    return (spec.period_start == dt.date(spec.period_start.year, 1, 1)
            and spec.period_end == dt.date(spec.period_start.year, 12, 31))


def period_text(spec: ChurnSpec) -> str:
    if _whole_year(spec):
        return str(spec.period_start.year)
    return f"{spec.period_start.isoformat()}..{spec.period_end.isoformat()}"


def excluded_events(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """The event rows the fact leaves out, with the first reason that applies."""
    reason = (F.when(F.col("is_unmapped_user"), "source id not in identity map")
              .when(F.col("has_ambiguous_mapping"), "source id maps to multiple unified users")
              .when(F.col("activity_date").isNull(), "activity date missing")
              .when(~F.col("is_in_analysis_period"), f"activity date outside {period_text(spec)}"))
    return events.filter(~F.col("is_in_scope")).select(
        "channel", "source_feed", "source_event_id", "source_user_id", "activity_date", "quarter_label",
        "event_or_status", "amount_sar", reason.alias("exclusion_reason"))


def publish_gate(dq: DataFrame, raise_on_block: bool = False) -> DataFrame:
    """One row — blocking (error-graded) failures, warnings, can_publish.

    ``raise_on_block``: the row carries ``raise_error`` so evaluating it fails
    the job when publication is blocked."""
    fail = F.col("check_status") == "FAIL"
    g = dq.agg(F.count_if(fail & (F.col("severity") == "error")).alias("blocking_failures"),
               F.count_if(fail & (F.col("severity") == "warn")).alias("warnings"),
               F.sort_array(F.collect_list(F.when(fail & (F.col("severity") == "error"), F.col("check_name"))))
               .alias("blocking_checks"))
    g = g.withColumn("can_publish", F.col("blocking_failures") == 0)
    if raise_on_block:
        g = g.withColumn("can_publish", F.when(F.col("can_publish"), F.lit(True)).otherwise(
            F.raise_error(F.lit("publication blocked by failing error-graded checks")).cast("boolean")))
    return g
