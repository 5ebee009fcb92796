"""Layer 7a: pending exposure and approval maturity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.rates import rate
from lapsekit.operators.fact import active_col
from lapsekit.spec import ALL_SOURCES_LABEL, APPROVED, CASHBACK, PENDING, ChurnSpec, DEFAULT_SPEC


def pending_exposure(fact: DataFrame, events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Per period, the share of the broad active base that a pending decision
    could still remove, next to the period's cashback volume. Cashback volume
    counts every transaction purchased in the period (mapped or not);
    ``unmapped_transactions`` says how many of them reach no person."""
    p, s = spec.primary, spec.strict
    users = fact.groupBy("quarter_label").agg(
        F.count_if(F.col(active_col(p))).alias(f"active_users_{p.name}"),
        F.count_if(F.col(active_col(s))).alias(f"active_users_{s.name}"),
        F.count_if(F.col("is_active_on_pending_only")).alias("users_active_only_via_pending"),
        F.count_if(F.col(active_col(p)) & (F.col("cashback_pending_transactions") > 0))
        .alias("active_users_with_any_pending"))
    pend = F.col("event_or_status") == PENDING
    cash = (events.filter(F.col("channel") == CASHBACK).groupBy("quarter_label").agg(
        F.count(F.lit(1)).alias("cashback_transactions"),
        F.count_if(pend).alias("pending_transactions"),
        F.sum("amount_sar").alias("gross_amount_sar"),
        F.sum(F.when(pend, F.col("amount_sar")).otherwise(F.lit(0).cast("decimal(38,9)")))
        .alias("pending_amount_sar"),
        F.count_if(F.col("is_unmapped_user")).alias("unmapped_transactions")))
    j = users.join(cash, "quarter_label", "left")
    return j.select(
        "quarter_label", f"active_users_{p.name}", f"active_users_{s.name}", "users_active_only_via_pending",
        "active_users_with_any_pending",
        rate("users_active_only_via_pending", f"active_users_{p.name}").alias("share_of_active_base_at_risk"),
        "cashback_transactions", "pending_transactions",
        rate("pending_transactions", "cashback_transactions").alias("pending_transaction_rate"),
        "pending_amount_sar", "gross_amount_sar", "unmapped_transactions")


def approval_maturity(txns: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Over decided transactions, per network and for all networks together
    (one ``rollup`` pass, ``grouping()`` tells the total row from a NULL network):
    eventual approval rate, share decided within each horizon, p50/p90/max days."""
    d = txns.filter(F.col("status_updated_date").isNotNull())
    days = F.col("days_to_status_decision")
    agg = d.rollup("source").agg(
        F.grouping("source").alias("_total"),
        F.count(F.lit(1)).alias("decided_transactions"),
        F.count_if(F.col("status") == APPROVED).alias("_approved"),
        *[F.count_if(days <= h).alias(f"_within_{h}") for h in spec.horizons],
        F.percentile_approx(days, 0.5, 10000).alias("p50_days_to_decision"),
        F.percentile_approx(days, 0.9, 10000).alias("p90_days_to_decision"),
        F.max(days).alias("max_days_to_decision"))
    return agg.select(
        F.when(F.col("_total") == 1, F.lit(ALL_SOURCES_LABEL)).otherwise(F.col("source")).alias("source"),
        "decided_transactions",
        rate("_approved", "decided_transactions").alias("eventual_approval_rate"),
        *[rate(f"_within_{h}", "decided_transactions").alias(f"decided_within_{h}d") for h in spec.horizons],
        "p50_days_to_decision", "p90_days_to_decision", "max_days_to_decision")
