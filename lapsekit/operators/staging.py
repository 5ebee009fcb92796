"""Layer 1: normalise, de-duplicate and flag.

Nothing is filtered. Each business key is collapsed by ONE aggregate (a single
shuffle with map-side partial aggregation, so a key that holds a third of all
rows is combined inside the map tasks before it is shuffled):

* ``raw_row_count``           = count(*)
* kept row                    = min(struct(order columns..., rest of payload))
* ``has_conflicting_duplicate`` = min(payload) is not null-safe-equal to max(payload)

The struct holds every payload column after the ordering columns, so the kept
row is deterministic even when conflicting copies tie on the ordering columns.
Rows whose key is NULL are kept uncollapsed (they cannot be told apart, and
none of them is a duplicate of another).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.text import norm_code, norm_key
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC, UNKNOWN_STATUS_CLASS


def collapse_duplicates(df: DataFrame, key: str, order: list[str], keep: str = "first") -> DataFrame:
    """Keep one row per ``key``; add raw_row_count, was_duplicated_in_raw,
    has_conflicting_duplicate. ``order``: ordering columns (ascending, NULLs
    first); ``keep='first'`` keeps the smallest row, ``'latest'`` the largest."""
    payload = [c for c in df.columns if c != key]
    ordered = list(order) + [c for c in payload if c not in order]
    row = F.struct(*[F.col(c) for c in ordered])
    if keep == "first":
        aggs, lo, hi = [F.min(row).alias("_kept"), F.max(row).alias("_other")], "_kept", "_other"
    else:
        aggs, lo, hi = [F.max(row).alias("_kept"), F.min(row).alias("_other")], "_other", "_kept"
    # A NULL key cannot be matched to anything: each such row is its own group.
    # It gets a unique surrogate in the grouping key, so NULL-key rows are neither
    # collapsed nor gathered into one (possibly huge) group, and the whole table
    # is still one scan and one aggregate.
    nk = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    collapsed = (
        df.groupBy(F.col(key), nk.alias("_nk"))
        .agg(F.count(F.lit(1)).alias("raw_row_count"), *aggs)
    )
    out = collapsed.select(
        F.col(key), *[F.col(f"_kept.{c}").alias(c) for c in payload],
        F.col("raw_row_count"),
        (F.col("raw_row_count") > 1).alias("was_duplicated_in_raw"),
        (~F.col(lo).eqNullSafe(F.col(hi))).alias("has_conflicting_duplicate"),
    )
    return out.select(*df.columns, "raw_row_count", "was_duplicated_in_raw", "has_conflicting_duplicate")


def stage_identity(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per (source_system, source_user_id), flag ids mapped to >1 person.

    The smallest non-NULL person is kept; a key whose persons are all NULL keeps
    NULL (and is reported by the null-key check)."""
    n = raw.select(norm_code("source_system").alias("source_system"),
                   norm_key("source_user_id").alias("source_user_id"),
                   norm_key("unified_user_id").alias("unified_user_id"))
    has_key = F.col("source_system").isNotNull() & F.col("source_user_id").isNotNull()
    nk = F.when(~has_key, F.monotonically_increasing_id())   # NULL-key rows stay one row each
    return (n.groupBy("source_system", "source_user_id", nk.alias("_nk"))
            .agg(F.min("unified_user_id").alias("unified_user_id"),
                 F.coalesce(F.min("unified_user_id") < F.max("unified_user_id"), F.lit(False))
                 .alias("has_ambiguous_mapping"))
            .drop("_nk"))


def stage_coupons(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Coupon events, one row per coupon_event_id, plus is_eligible_event."""
    n = raw.select(norm_key("coupon_event_id").alias("coupon_event_id"),
                   norm_key("coupon_user_id").alias("coupon_user_id"),
                   F.col("event_date").cast("date").alias("event_date"),
                   norm_key("merchant_id").alias("merchant_id"),
                   norm_code("event_type").alias("event_type"))
    out = collapse_duplicates(n, "coupon_event_id",
                              ["event_date", "coupon_user_id", "merchant_id", "event_type"])
    return out.withColumn(
        "is_eligible_event",
        F.coalesce(F.col("event_type").isin(*spec.eligible_event_types), F.lit(False)))


def status_class(c, spec: ChurnSpec = DEFAULT_SPEC):
    expr = None
    for status, cls in spec.status_classes:
        expr = (F.when(c == status, cls) if expr is None else expr.when(c == status, cls))
    return expr.otherwise(UNKNOWN_STATUS_CLASS)


def stage_cashback(raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Cashback transactions, one row per transaction_id, plus status_class and
    days_to_status_decision (workflow latency; never used to date activity).

    ``spec.keep='first'``: order purchase_date, status_updated_date, status, amount
    (an undecided copy sorts first); ``'latest'``: the copy with the latest decision."""
    n = raw.select(norm_key("transaction_id").alias("transaction_id"),
                   norm_key("cashback_user_id").alias("cashback_user_id"),
                   F.col("purchase_date").cast("date").alias("purchase_date"),
                   norm_key("merchant_id").alias("merchant_id"),
                   norm_key("source").alias("source"),
                   norm_code("status").alias("status"),
                   F.col("status_updated_date").cast("date").alias("status_updated_date"),
                   F.col("amount_sar").cast("decimal(38,9)").alias("amount_sar"))
    if spec.keep == "first":
        order = ["purchase_date", "status_updated_date", "status", "amount_sar"]
    else:
        order = ["status_updated_date", "purchase_date", "status", "amount_sar"]
    out = collapse_duplicates(n, "transaction_id", order, keep=spec.keep)
    return out.select(
        "*",
        status_class(F.col("status"), spec).alias("status_class"),
        F.datediff(F.col("status_updated_date"), F.col("purchase_date")).cast("long")
        .alias("days_to_status_decision"),
    )
