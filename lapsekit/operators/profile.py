"""Layer 6a: affiliate feed profile and cross-network duplicate suspects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsekit.functions.periods import period_label, period_start
from lapsekit.functions.rates import rate
from lapsekit.spec import CASHBACK, ChurnSpec, DEFAULT_SPEC

_STEP = {"quarter": "interval 3 months", "month": "interval 1 month", "week": "interval 7 days"}

PROFILE_COUNTS = [
    "transactions", "distinct_source_users", "rows_duplicated_in_raw", "rows_with_conflicting_duplicate",
    "rows_with_unmapped_user", "approved_txns", "pending_txns", "rejected_txns", "cancelled_txns",
    "unknown_status_txns",
]


def source_profile(txns: DataFrame, identity: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Per network x purchase period: volume, users, duplicates, unmapped,
    status mix, amounts, decision latency (approximate p50 with bounded memory,
    max), decisions landing in a later period, rates and change vs the prior period.

    The series is dense: each network runs from its first period to the last
    period seen in any feed, and a silent period is a row with zero counts, so
    the prior-period comparison never skips a gap. Rows with no purchase date keep
    their own (NULL period) row outside the series. Transactions that carry their person
    (``events.with_person``) are not joined with the map.
    """
    g = spec.grain
    if "unified_user_id" in txns.columns:
        j = txns.withColumnRenamed("unified_user_id", "_m_person")
    else:
        m = (identity.filter(F.col("source_system") == CASHBACK)
             .select(F.col("source_user_id").alias("_m_id"), F.col("unified_user_id").alias("_m_person")))
        j = txns.join(m, txns["cashback_user_id"] == m["_m_id"], "left")
    st = F.col("status")
    upd, pur = F.col("status_updated_date"), F.col("purchase_date")
    keyed = j.withColumn("_p", period_start(pur, g))
    counts = keyed.groupBy("source", "_p").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col("was_duplicated_in_raw")).alias("rows_duplicated_in_raw"),
        F.count_if(F.col("has_conflicting_duplicate")).alias("rows_with_conflicting_duplicate"),
        F.count_if(F.col("_m_person").isNull()).alias("rows_with_unmapped_user"),
        F.count_if(st == "approved").alias("approved_txns"),
        F.count_if(st == "pending").alias("pending_txns"),
        F.count_if(st == "rejected").alias("rejected_txns"),
        F.count_if(st == "cancelled").alias("cancelled_txns"),
        F.count_if(F.col("status_class") == "unknown").alias("unknown_status_txns"),
        F.sum("amount_sar").alias("gross_amount_sar"),
        F.sum(F.when(st == "approved", F.col("amount_sar")).otherwise(F.lit(0).cast("decimal(38,9)")))
        .alias("approved_amount_sar"),
        F.sum(F.when(st == "pending", F.col("amount_sar")).otherwise(F.lit(0).cast("decimal(38,9)")))
        .alias("pending_amount_sar"),
        F.percentile_approx("days_to_status_decision", 0.5, 10000).alias("median_days_to_decision"),
        F.max("days_to_status_decision").alias("max_days_to_decision"),
        F.count_if(upd.isNotNull() & (period_start(upd, g) > period_start(pur, g)))
        .alias("decisions_landing_in_later_quarter"),
    )
    # distinct users apart from the sketch of the median, which would else be kept once a user
    users = (keyed.groupBy("source", "_p", "cashback_user_id").agg(F.count(F.lit(1)))
             .groupBy("source", "_p").agg(F.count("cashback_user_id").alias("distinct_source_users")))
    u, c = users.alias("u"), counts.alias("c")
    both = c.join(u, F.col("c.source").eqNullSafe(F.col("u.source")) & F.col("c._p").eqNullSafe(F.col("u._p")))
    sparse = both.select("c.*", "u.distinct_source_users")
    w0 = Window.partitionBy()                      # over one row a network and period
    sparse = sparse.withColumns({"_last": F.max("_p").over(w0), "_next": F.lead("_p").over(
        Window.partitionBy("source", F.col("_p").isNull()).orderBy("_p"))})
    # dense: each period is followed by empty rows up to the next one (or to the last of any feed)
    step = F.expr(_STEP[g])
    until = F.coalesce("_next", F.date_add("_last", 1))
    periods = F.filter(F.sequence("_p", until, step), lambda x: x < until)
    span = F.when(F.col("_p").isNull(), F.array(F.col("_p"))).otherwise(periods)
    grown = sparse.select("*", F.posexplode(span).alias("_i", "_q"))
    own = F.col("_i") == 0
    dense = grown.select(
        "source", F.col("_q").alias("_p"),
        *[F.when(own, F.col(c)).otherwise(F.lit(0).cast("long")).alias(c) for c in PROFILE_COUNTS],
        *[F.when(own, F.col(c)).alias(c) for c in ["gross_amount_sar", "approved_amount_sar", "pending_amount_sar",
                                                   "median_days_to_decision", "max_days_to_decision"]],
        F.when(own, F.col("decisions_landing_in_later_quarter")).otherwise(F.lit(0).cast("long"))
        .alias("decisions_landing_in_later_quarter"),
    )
    w = Window.partitionBy("source", F.col("_p").isNull()).orderBy("_p")
    prior = F.when(F.col("_p").isNotNull(), F.lag("transactions").over(w))
    return dense.select(
        "source", period_label("_p", g).alias("quarter_label"), *PROFILE_COUNTS,
        "gross_amount_sar", "approved_amount_sar", "pending_amount_sar", "median_days_to_decision",
        "max_days_to_decision", "decisions_landing_in_later_quarter",
        rate("approved_txns", "transactions").alias("approval_rate"),
        rate("pending_txns", "transactions").alias("pending_rate"),
        rate(F.col("rejected_txns") + F.col("cancelled_txns"), F.col("transactions")).alias("failed_rate"),
        rate("rows_with_unmapped_user", "transactions").alias("unmapped_rate"),
        prior.alias("prior_quarter_transactions"),
        rate(F.col("transactions") - prior, prior).alias("transactions_qoq_change"),
    )


_DUP_KEYS = ["cashback_user_id", "purchase_date", "merchant_id", "amount_sar"]


def cross_source_duplicates(txns: DataFrame) -> DataFrame:
    """Same user, day, merchant and amount reported by more than one network.

    One aggregate with bounded state per group: a count, and the sorted set of
    networks (bounded by the number of networks). The transaction ids behind a
    suspect are in :func:`cross_source_duplicate_members` as rows, so no group,
    however large, is gathered into a single array."""
    return (txns.groupBy(*_DUP_KEYS)
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 F.array_sort(F.collect_set("source")).alias("sources"))
            .select(*_DUP_KEYS, "transaction_count", F.size("sources").cast("long").alias("distinct_sources"),
                    "sources")
            .filter(F.col("distinct_sources") > 1))


def cross_source_duplicate_members(txns: DataFrame) -> DataFrame:
    """M15 detail: one row per transaction of a suspect group (group keys, network, id)."""
    suspects = cross_source_duplicates(txns).select(*_DUP_KEYS)
    cond = [txns[c].eqNullSafe(suspects[c]) for c in _DUP_KEYS]
    return (txns.join(suspects, cond, "left_semi")
            .select(*_DUP_KEYS, "source", "transaction_id"))
