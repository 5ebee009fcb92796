"""Layer 8: walk one person from raw rows to final classification (M23a-f).

Each step is a filter on one layer; on materialised, user-clustered layers the
person filter is pushed into the Parquet scan (row-group statistics skip the
rest). Raw source ids are normalised before they are matched to the map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsekit.functions.text import norm_key
from lapsekit.operators.events import activity_col
from lapsekit.spec import CASHBACK, COUPON, ChurnSpec, DEFAULT_SPEC


def trace_identity(identity: DataFrame, user: str) -> DataFrame:
    return identity.filter(F.col("unified_user_id") == user).select(
        F.lit("step 1 - identity").alias("step"), "source_system", "source_user_id", "unified_user_id")


def trace_raw(raw_coupons: DataFrame, raw_cashback: DataFrame, identity: DataFrame, user: str) -> DataFrame:
    ids = identity.filter(F.col("unified_user_id") == user).select("source_system", "source_user_id")
    cid = ids.filter(F.col("source_system") == COUPON).select(F.col("source_user_id").alias("_id"))
    bid = ids.filter(F.col("source_system") == CASHBACK).select(F.col("source_user_id").alias("_id"))
    c = (raw_coupons.join(cid, norm_key("coupon_user_id") == F.col("_id"), "left_semi").select(
        F.lit("step 2 - raw coupon").alias("step"), F.col("coupon_event_id").alias("record_id"),
        F.col("event_date").alias("activity_date"), F.col("event_type").alias("event_or_status"),
        F.lit(None).cast("string").alias("source_feed"), F.lit(None).cast("decimal(38,9)").alias("amount_sar")))
    b = (raw_cashback.join(bid, norm_key("cashback_user_id") == F.col("_id"), "left_semi").select(
        F.lit("step 2 - raw cashback").alias("step"), F.col("transaction_id").alias("record_id"),
        F.col("purchase_date").alias("activity_date"), F.col("status").alias("event_or_status"),
        F.col("source").alias("source_feed"), F.col("amount_sar").cast("decimal(38,9)").alias("amount_sar")))
    return c.unionByName(b)


def trace_events(events: DataFrame, user: str, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    return events.filter(F.col("unified_user_id") == user).select(
        F.lit("step 3 - unified events").alias("step"), "channel", "source_feed", "source_event_id",
        "activity_date", "quarter_label", "event_or_status", *[activity_col(d) for d in spec.definitions],
        "is_in_scope")


def trace_fact(fact: DataFrame, user: str, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    return fact.filter(F.col("unified_user_id") == user).select(
        F.lit("step 4 - user x quarter").alias("step"), "quarter_label", "eligible_coupon_events",
        "cashback_approved_transactions", "cashback_pending_transactions", "cashback_excluded_transactions",
        "activity_mix", *[f"is_active_{d.name}" for d in spec.definitions], "is_active_on_pending_only")


def trace_cohort(cohort_users: DataFrame, user: str) -> DataFrame:
    status = [c for c in cohort_users.columns if c.endswith("_cohort_status")][0]
    flags = [c for c in cohort_users.columns if c.startswith("active_q")]
    return cohort_users.filter(F.col("unified_user_id") == user).select(
        F.lit("step 5 - classification").alias("step"), "definition_name", "activity_pattern", status, *flags)


def trace_contribution(long: DataFrame, user: str) -> DataFrame:
    w = Window.partitionBy("definition_name").orderBy("quarter_index")
    nxt = F.lead("is_active").over(w)
    return long.filter(F.col("unified_user_id") == user).select(
        F.lit("step 6 - contribution").alias("step"), "definition_name",
        F.col("quarter_label").alias("from_quarter"), F.col("is_active").alias("active_in_from_quarter"),
        nxt.alias("active_in_next_quarter"),
        F.when(nxt.isNull(), "no next quarter in scope").when(~F.col("is_active"), "not in base")
        .when(nxt, "retained").otherwise("churned").alias("contributes_as"))
