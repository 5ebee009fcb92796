"""Layer 2: one activity event grammar across channels, identity resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.periods import period_label, period_start
from lapsekit.spec import CASHBACK, COUPON, COUPON_FEED_NAME, ChurnSpec, DEFAULT_SPEC


PERSON = ("unified_user_id", "has_ambiguous_mapping")


def activity_col(d) -> str:
    return f"counts_as_activity_{d.name}"


def channel_events(coupons: DataFrame, cashback: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Both staged channels as rows of one grammar (before identity resolution).

    Coupons are dated by event_date, cashback by purchase_date; the decision date
    never dates activity. A person that both feeds carry (:func:`with_person`) stays."""
    dec = "decimal(38,9)"
    person = [x for x in PERSON if x in coupons.columns and x in cashback.columns]
    c = coupons.select(
        F.lit(COUPON).alias("channel"), F.lit(COUPON_FEED_NAME).alias("source_feed"),
        F.col("coupon_event_id").alias("source_event_id"),
        F.col("coupon_user_id").alias("source_user_id"),
        F.col("event_date").alias("activity_date"), "merchant_id",
        F.col("event_type").alias("event_or_status"), F.lit(None).cast(dec).alias("amount_sar"),
        *[F.col("is_eligible_event").alias(activity_col(d)) for d in spec.definitions],
        "was_duplicated_in_raw", "has_conflicting_duplicate",
        F.lit(None).cast("date").alias("status_updated_date"), *person)
    b = cashback.select(
        F.lit(CASHBACK).alias("channel"), F.col("source").alias("source_feed"),
        F.col("transaction_id").alias("source_event_id"),
        F.col("cashback_user_id").alias("source_user_id"),
        F.col("purchase_date").alias("activity_date"), "merchant_id",
        F.col("status").alias("event_or_status"), F.col("amount_sar").cast(dec).alias("amount_sar"),
        *[F.coalesce(F.col("status").isin(*d.cashback_statuses), F.lit(False)).alias(activity_col(d))
          for d in spec.definitions],
        "was_duplicated_in_raw", "has_conflicting_duplicate", "status_updated_date", *person)
    return c.unionByName(b)


def with_person(staged: DataFrame, identity: DataFrame, system: str, user: str) -> DataFrame:
    """Staged rows of a channel with the person that the identity map names for their ``user`` id (NULL:
    none), and whether it names several. :func:`resolve_events` joins such rows no more."""
    m = identity.filter((F.col("source_system") == system) & F.col("source_user_id").isNotNull()).select(
        F.col("source_user_id").alias("_m_id"), "unified_user_id", F.col("has_ambiguous_mapping").alias("_m_ambiguous"))
    j = staged.join(m, staged[user] == m["_m_id"], "left")
    return j.select(*[staged[c] for c in staged.columns], "unified_user_id",
                    F.coalesce("_m_ambiguous", F.lit(False)).alias("has_ambiguous_mapping"))


def in_period(c, spec: ChurnSpec):
    return F.coalesce(c.between(F.lit(spec.period_start), F.lit(spec.period_end)), F.lit(False))


def unify_events(coupons: DataFrame, cashback: DataFrame, identity: DataFrame,
                 spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Union the channels, resolve each source id through the identity map
    (left join on system + id; AQE picks broadcast or sort-merge from runtime
    sizes and splits a skewed id), add period columns and scope flags.

    Exclusions are carried as flags, never applied: ``is_in_scope`` is what the
    fact layer filters on. A NULL activity date is out of period (not NULL). An identity map
    with ``valid_from`` and ``valid_before`` (``extensions.disjoint_identity``: ranges that do not
    overlap) is read as of the activity date, so persons can change over time (E12).
    ``status_updated_date`` (cashback decision date, NULL for coupons) is carried
    for the as-of restatement only; it never dates activity."""
    return with_period_columns(resolve_events(coupons, cashback, identity, spec), spec)


def resolve_events(coupons: DataFrame, cashback: DataFrame, identity: DataFrame,
                   spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """The rows of :func:`unify_events` before the columns that follow from others of the row: what a
    store shuffles to its folders. Feeds that carry the person are not joined with the map again."""
    ev = channel_events(coupons, cashback, spec)
    columns = [
        "channel", "source_feed", "source_event_id", "source_user_id", "unified_user_id", "activity_date",
        "merchant_id", "event_or_status", "amount_sar", *[activity_col(x) for x in spec.definitions],
        "was_duplicated_in_raw", "has_conflicting_duplicate", "has_ambiguous_mapping", "status_updated_date"]
    if set(PERSON) <= set(ev.columns):
        return ev.select(*columns)
    m = identity.filter(F.col("source_system").isNotNull() & F.col("source_user_id").isNotNull()).select(
        F.col("source_system").alias("_m_system"), F.col("source_user_id").alias("_m_id"),
        "unified_user_id", F.col("has_ambiguous_mapping").alias("_m_ambiguous"),
        *[c for c in ("valid_from", "valid_before") if c in identity.columns])
    same = (ev["channel"] == m["_m_system"]) & (ev["source_user_id"] == m["_m_id"])
    if "valid_before" in m.columns:
        same = same & (ev["activity_date"] >= m["valid_from"]) & (ev["activity_date"] < m["valid_before"])
    j = ev.join(m, same, "left")
    return j.withColumn("has_ambiguous_mapping", F.coalesce(F.col("_m_ambiguous"), F.lit(False))).select(*columns)


def with_period_columns(resolved: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Period columns and scope flags of resolved rows; columns of a store beside them stay, at the end."""
    d = F.col("activity_date")
    unmapped = F.col("unified_user_id").isNull()
    inp = in_period(d, spec)
    out = resolved.withColumns({
        "quarter_start_date": period_start(d, spec.grain), "quarter_label": period_label(d, spec.grain),
        "is_unmapped_user": unmapped, "is_in_analysis_period": inp,
        "is_in_scope": ~unmapped & ~F.col("has_ambiguous_mapping") & inp})
    columns = [
        "channel", "source_feed", "source_event_id", "source_user_id", "unified_user_id",
        "activity_date", "quarter_start_date", "quarter_label", "merchant_id", "event_or_status", "amount_sar",
        *[activity_col(x) for x in spec.definitions],
        "was_duplicated_in_raw", "has_conflicting_duplicate", "is_unmapped_user", "has_ambiguous_mapping",
        "is_in_analysis_period", "is_in_scope", "status_updated_date"]
    return out.select(*columns, *[c for c in resolved.columns if c not in columns])
