"""Mergeable sketches of a feed by network and month (M14, M19, E09 over any range of months).

One row a network and month holds a distinct sketch of the users (HyperLogLog, ``2**LG_K`` registers) and a
quantile sketch of the days to a decision (KLL). Ranges, networks and totals are unions of these rows, so a
question about a year reads some hundred rows and no transaction. Distinct counts are within ``USERS_ERROR``
(relative, three standard errors); a quantile's rank is within ``RANK_ERROR`` of the one asked for (three times
the sketch's own bound at 99 %). Sketches take rows in but never out: months in which rows were restated are
sketched anew (:func:`refreshed`).

NULL users and undecided rows enter no sketch; rows without a purchase date form the month NULL, which no range holds
but the quantiles over all months do. An empty feed has no sketch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.spec import ALL_SOURCES_LABEL

LG_K = 14
USERS_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
QUANTILE_K = 800
RANK_ERROR = 0.01

Range = tuple[dt.date, dt.date]


def _month(day: str) -> Column:
    return F.trunc(day, "month")


def feed_sketches(txns: DataFrame) -> DataFrame:
    """(source, month, transactions, users, decision_days): partial sketches are made in the map tasks, so a hot
    network or month reaches the shuffle as one sketch a task."""
    return txns.groupBy("source", _month("purchase_date").alias("month")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.hll_sketch_agg("cashback_user_id", LG_K).alias("users"),
        F.kll_sketch_agg_bigint(F.col("days_to_status_decision").cast("long"), QUANTILE_K).alias("decision_days"))


def refreshed(sketches: DataFrame, txns: DataFrame, months: Sequence[dt.date | None]) -> DataFrame:
    """``sketches`` with those of ``months`` (first days; None: rows without a date) made anew from ``txns``."""
    days = [m for m in months if m is not None]

    def touched(month: Column) -> Column:
        return F.coalesce(month.isin(days), F.lit(False)) | (month.isNull() & F.lit(None in months))

    return (sketches.filter(~touched(F.col("month")))
            .unionByName(feed_sketches(txns.filter(touched(_month("purchase_date"))))))


def _in_ranges(df: DataFrame, month: Column, ranges: Sequence[Range]) -> DataFrame:
    """``df`` once for each range of months that holds its month."""
    all_ranges = F.array(*[F.struct(F.lit(a).alias("from_month"), F.lit(b).alias("to_month")) for a, b in ranges])
    return (df.withColumn("_r", F.explode(F.filter(all_ranges, lambda r: month.between(r["from_month"], r["to_month"]))))
            .withColumns({"from_month": F.col("_r.from_month"), "to_month": F.col("_r.to_month")}).drop("_r"))


def _source(total: str = "_total") -> Column:
    return F.when(F.col(total) == 1, F.lit(ALL_SOURCES_LABEL)).otherwise(F.col("source")).alias("source")


def users_in_ranges(sketches: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """(source, from_month, to_month, transactions, users): distinct users of each network, and of all networks
    together, over each range of months (first days, both ends included); a user of several months counts once."""
    held = _in_ranges(sketches, F.col("month"), ranges)
    return (held.groupingSets([["source", "from_month", "to_month"], ["from_month", "to_month"]], "source", "from_month", "to_month")
            .agg(F.grouping("source").alias("_total"), F.sum("transactions").alias("transactions"),
                 F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
            .select(_source(), "from_month", "to_month", "transactions", "users"))


def exact_users_in_ranges(txns: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """The exact counts that :func:`users_in_ranges` estimates, from the transactions."""
    once = (txns.filter(F.col("cashback_user_id").isNotNull())
            .select("source", "cashback_user_id", _month("purchase_date").alias("month")).distinct())
    held = _in_ranges(once, F.col("month"), ranges)
    return (held.groupingSets([["source", "from_month", "to_month", "cashback_user_id"],
                               ["from_month", "to_month", "cashback_user_id"]],
                              "source", "from_month", "to_month", "cashback_user_id")
            .agg(F.grouping("source").alias("_total"))
            .groupBy(_source(), "from_month", "to_month").agg(F.count(F.lit(1)).alias("exact_users")))


def users_check(sketches: DataFrame, txns: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """Per network and range: transactions, the exact count, and whether the estimate keeps ``USERS_ERROR``."""
    s, e = users_in_ranges(sketches, ranges).alias("s"), exact_users_in_ranges(txns, ranges).alias("e")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("source", "from_month", "to_month")]
    exact = F.coalesce("e.exact_users", F.lit(0))
    return s.join(e, same, "left").select("s.source", "s.from_month", "s.to_month", "s.transactions", exact.alias("exact_users"),
                                          (F.abs(F.col("s.users") - exact) <= USERS_ERROR * exact).alias("within_error"))


def decision_quantiles(sketches: DataFrame, shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(source, share, decided_transactions, days): quantiles of the days to a decision over all months, of each
    network and of all together; networks without a decision are left out."""
    merged = (sketches.rollup("source").agg(F.grouping("source").alias("_total"),
                                            F.kll_merge_agg_bigint("decision_days", QUANTILE_K).alias("sketch"))
              .withColumn("decided_transactions", F.kll_sketch_get_n_bigint("sketch")).filter("decided_transactions > 0"))
    asked = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("share"), F.kll_sketch_get_quantile_bigint(
        "sketch", F.lit(float(p))).alias("days")) for p in shares])).alias("_q")
    return (merged.select(_source(), "decided_transactions", asked)
            .select("source", "_q.share", "decided_transactions", "_q.days"))


def quantiles_check(sketches: DataFrame, txns: DataFrame, shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Per network and share: the decided transactions, and whether the quantile's rank among them, measured on the
    rows, is within ``RANK_ERROR`` of the share (rows of equal days span a range of ranks)."""
    days = F.col("days_to_status_decision")
    each = (txns.filter(days.isNotNull()).groupBy("source", days.alias("d")).agg(F.count(F.lit(1)).alias("n")))
    hist = each.unionByName(each.groupBy("d").agg(F.sum("n").alias("n"))
                            .select(F.lit(ALL_SOURCES_LABEL).alias("source"), "d", "n"))  # bounded by the days
    q = decision_quantiles(sketches, shares).alias("q")
    h = hist.alias("h")
    ranked = (q.join(h, F.col("q.source").eqNullSafe(F.col("h.source")))
              .groupBy("q.source", "q.share", "q.decided_transactions")
              .agg(F.sum("n").alias("all"), F.sum(F.when(F.col("d") < F.col("days"), F.col("n")).otherwise(0)).alias("below"),
                   F.sum(F.when(F.col("d") <= F.col("days"), F.col("n")).otherwise(0)).alias("upto")))
    return ranked.select("source", "share", "decided_transactions",
                         ((F.col("all") == F.col("decided_transactions"))
                          & (F.col("below") <= (F.col("share") + RANK_ERROR) * F.col("all"))
                          & (F.col("upto") >= (F.col("share") - RANK_ERROR) * F.col("all"))).alias("within_rank_error"))
