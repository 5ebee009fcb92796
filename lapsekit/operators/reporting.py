"""Layers 9-10: tidy summary, headline view and the long reporting shapes
(M24-M27). Wide marts become long with ``stack`` (a Generate: no shuffle)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.periods import periods_of
from lapsekit.functions.rates import rate
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC

DEC = "decimal(38,9)"


def _long(df: DataFrame, keys: list, metrics: list[str]) -> DataFrame:
    parts = [x for m in metrics for x in (F.lit(m), F.col(m).cast(DEC))]
    return df.select(*keys, F.stack(F.lit(len(metrics)), *parts).alias("metric", "value"))


def report_summary(active_base: DataFrame, transitions: DataFrame, cohort_summary: DataFrame,
                   pending: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """section_order, section, definition_name, period, metric, value (decimal)."""
    a = spec.cohort_anchor
    anchor_label = periods_of(spec.period_start, spec.period_end, spec.grain)[a - 1].label
    react = [c for c in cohort_summary.columns if c.startswith("reactivated_in_") and c.endswith("_users")][0]
    s1 = _long(active_base, [F.lit(1).alias("section_order"), F.lit("Active base").alias("section"),
                             "definition_name", F.col("quarter_label").alias("period")],
               ["active_users", "active_coupon_only", "active_cashback_only", "active_both_channels",
                "active_on_pending_only"])
    s2 = _long(transitions, [F.lit(2).alias("section_order"), F.lit("Quarter transitions").alias("section"),
                             "definition_name",
                             F.concat(F.col("from_quarter"), F.lit(" -> "), F.col("to_quarter")).alias("period")],
               ["active_base", "retained_users", "churned_users", "next_quarter_churn_rate",
                "next_quarter_retention_rate"])
    s3 = _long(cohort_summary, [F.lit(3).alias("section_order"), F.lit(f"Q{a} cohort").alias("section"),
                                "definition_name", F.lit(f"{anchor_label} cohort").alias("period")],
               [f"q{a}_cohort_users", f"retained_in_q{a + 1}", f"lapsed_in_q{a + 1}", "confirmed_churn_users",
                "confirmed_churn_rate_of_cohort", react, f"reactivation_rate_of_lapsed_q{a + 1}"])
    s4 = _long(pending, [F.lit(4).alias("section_order"), F.lit("Pending exposure").alias("section"),
                         F.lit(spec.primary.name).alias("definition_name"),
                         F.col("quarter_label").alias("period")],
               ["pending_transactions", "pending_transaction_rate", "users_active_only_via_pending",
                "share_of_active_base_at_risk", "pending_amount_sar"])
    return reduce(DataFrame.unionByName, [s1, s2, s3, s4])


def headline(transitions: DataFrame, pending: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Primary-definition transitions with the strict rate, the delta and
    the pending risk of the from-period (one conditional aggregate over the
    transitions, then a left join to the per-period exposure)."""
    p, s = spec.primary.name, spec.strict.name
    d = F.col("definition_name")
    pick = lambda name, c: F.max(F.when(d == name, F.col(c)))
    t = transitions.groupBy("from_quarter", "to_quarter").agg(
        pick(p, "active_base").alias("active_base"), pick(p, "retained_users").alias("retained_users"),
        pick(p, "churned_users").alias("churned_users"),
        pick(p, "next_quarter_churn_rate").alias(f"churn_rate_{p}"),
        pick(s, "next_quarter_churn_rate").alias(f"churn_rate_{s}"),
        pick(s, "active_base").alias("_strict_base"))
    t = t.filter(F.col("active_base").isNotNull() & F.col("_strict_base").isNotNull())
    e = pending.select(F.col("quarter_label").alias("_q"), "share_of_active_base_at_risk")
    j = t.join(e, F.col("_q") == F.col("from_quarter"), "left")
    return j.select(
        "from_quarter", "to_quarter", "active_base", "retained_users", "churned_users", f"churn_rate_{p}",
        f"churn_rate_{s}", F.round(F.col(f"churn_rate_{s}") - F.col(f"churn_rate_{p}"), 4).alias("churn_rate_delta_pp"),
        F.col("share_of_active_base_at_risk").alias("from_quarter_pending_risk"))


def cohort_funnel(cohort_summary: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per definition x funnel stage, with its share of the cohort."""
    a = spec.cohort_anchor
    react = [c for c in cohort_summary.columns if c.startswith("reactivated_in_") and c.endswith("_users")][0]
    stages = [
        (1, f"Q{a} cohort", f"Active in Q{a}", f"q{a}_cohort_users"),
        (2, f"Q{a + 1} outcome", f"Retained in Q{a + 1}", f"retained_in_q{a + 1}"),
        (3, f"Q{a + 1} outcome", f"Lapsed in Q{a + 1}", f"lapsed_in_q{a + 1}"),
        (4, f"Q{a + 2} outcome", f"Reactivated in Q{a + 2}", react),
        (5, f"Q{a + 2} outcome", "Confirmed churn", "confirmed_churn_users"),
    ]
    parts = [x for o, g, s, c in stages for x in (F.lit(o), F.lit(g), F.lit(s), F.col(c).cast("long"))]
    long = cohort_summary.select("definition_name", F.col(f"q{a}_cohort_users").alias("_cohort"),
                                 F.stack(F.lit(len(stages)), *parts)
                                 .alias("stage_order", "stage_group", "stage", "users"))
    return long.select("definition_name", "stage_order", "stage_group", "stage", "users",
                       rate("users", "_cohort").alias("share_of_cohort"))


def maturity_curve(maturity: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per network x horizon (horizon as an integer)."""
    parts = [x for h in spec.horizons for x in (F.lit(h), F.col(f"decided_within_{h}d"))]
    return maturity.select("source", F.stack(F.lit(len(spec.horizons)), *parts).alias("horizon_days", "decided_share"),
                           "eventual_approval_rate", "decided_transactions")
