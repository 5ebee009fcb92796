"""Approval maturity with open rows as censored observations (M19, E14): a competing-risk
product-limit estimate per (network, merchant), drawn towards the network where a merchant is thin.

The curve of decided rows alone is biased on young cohorts: only their quick decisions are in.
Here a transaction that is undecided on the reporting date counts as at risk up to its age. With n rows
at risk on day t after the purchase, d of them decided and a of those approved, the share still
undecided is S(t) = product of (1 - d/n), and the share approved by t is the sum of S(t-1) * a/n.

Rows are first counted per (network, merchant, day), so the windows run over days and not over
transactions: no group grows with a network that holds a third of all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsekit.spec import APPROVED, ChurnSpec, DEFAULT_SPEC

SOURCE, MERCHANT = "source", "merchant_id"
PRIOR = 20.0  # transactions of the network that a merchant's own figures are weighed against


def days_at_risk(txns: DataFrame, as_of: dt.date) -> DataFrame:
    """Counts per (source, merchant, day): transactions that were last seen at risk on that day after their
    purchase, as known on ``as_of``. Decided ones leave on the day of the decision (not before day 0), open ones
    on their age; ``later`` counts the open ones that a later state of the feed shows approved."""
    known = F.lit(as_of)
    decided = F.coalesce(F.col("status_updated_date") <= known, F.lit(False))
    day = F.greatest(F.datediff(F.when(decided, F.col("status_updated_date")).otherwise(known), F.col("purchase_date")), F.lit(0))
    approved = F.col("status") == APPROVED
    return (txns.filter(F.col("purchase_date") <= known)
            .groupBy(SOURCE, MERCHANT, day.cast("long").alias("day")).agg(
                F.count(F.lit(1)).alias("seen"), F.count_if(decided).alias("decided"),
                F.count_if(decided & approved).alias("approved"),
                F.count_if(~decided & approved & F.col("status_updated_date").isNotNull()).alias("later")))


def product_limit(days: DataFrame, keys: list[str]) -> DataFrame:
    """The curve of every group at its days: at_risk, undecided S(day), approved_share by the day."""
    d = days.groupBy(*keys, "day").agg(*[F.sum(c).alias(c) for c in ("seen", "decided", "approved", "later")])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    upto = whole.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = (F.sum("seen").over(whole) - F.coalesce(F.sum("seen").over(before), F.lit(0))).alias("at_risk")
    d = d.select("*", n).withColumn("stay", 1 - F.col("decided").cast("double") / F.col("at_risk"))
    d = d.withColumn("_s", F.coalesce(F.product("stay").over(before), F.lit(1.0)))
    step = F.col("_s") * F.col("approved").cast("double") / F.col("at_risk")
    return d.select(*keys, "day", "seen", "decided", "later", "at_risk", (F.col("_s") * F.col("stay")).alias("undecided"),
                    F.sum(step).over(upto).alias("approved_share"))


def _drawn(own, n, network, prior: float):
    """A merchant's figure, weighed with its network's."""
    return F.round((F.coalesce(own, F.lit(0.0)) * n + network * prior) / (n + prior), 6)


def censored_maturity(txns: DataFrame, as_of: dt.date, spec: ChurnSpec = DEFAULT_SPEC, prior: float = PRIOR) -> DataFrame:
    """M19 with open rows, per (network, merchant): transactions, open ones, the share approved within each horizon
    and in the end, by the merchant's own rows and (``_drawn``) weighed with the network's."""
    days = days_at_risk(txns, as_of)
    horizons = {f"approved_within_{h}d": h for h in spec.horizons}

    def at_horizons(keys: list[str]) -> DataFrame:
        c = product_limit(days, keys)
        share = F.col("approved_share")
        return c.groupBy(*keys).agg(
            F.sum("seen").alias("transactions"), F.sum(F.col("seen") - F.col("decided")).alias("open_transactions"),
            *[F.coalesce(F.max(F.when(F.col("day") <= h, share)), F.lit(0.0)).alias(n) for n, h in horizons.items()],
            F.max(share).alias("eventually_approved"))

    names = [*horizons, "eventually_approved"]
    network = at_horizons([SOURCE]).select(F.col(SOURCE).alias("_source"), *[F.col(n).alias(f"_{n}") for n in names])
    own = at_horizons([SOURCE, MERCHANT])
    both = own.join(network, own[SOURCE].eqNullSafe(F.col("_source")))
    return both.select(SOURCE, MERCHANT, "transactions", "open_transactions",
                       *[F.round(n, 6).alias(n) for n in names],
                       *[_drawn(F.col(n), F.col("transactions"), F.col(f"_{n}"), prior).alias(f"{n}_drawn") for n in names])


def approvals_backtest(txns: DataFrame, dates: list[dt.date], prior: float = PRIOR) -> DataFrame:
    """E14 checked against what happened: per past date and network, the open transactions, the approvals expected
    of them (each by the chance of an approval given its age, from the merchant's curve drawn to its network's),
    and those that came. A chance is (share approved in the end - share approved by the age) / share undecided."""
    out = None
    for as_of in dates:
        days = days_at_risk(txns, as_of)

        def chances(keys: list[str]) -> DataFrame:
            c = product_limit(days, keys)
            end = F.max("approved_share").over(Window.partitionBy(*keys))
            return c.withColumn("chance", F.coalesce(F.try_divide(end - F.col("approved_share"), F.col("undecided")), F.lit(0.0)))

        own = chances([SOURCE, MERCHANT]).withColumn("n", F.sum("seen").over(Window.partitionBy(SOURCE, MERCHANT)))
        own = own.withColumn("open", F.col("seen") - F.col("decided")).filter("open > 0")
        network = chances([SOURCE]).select(F.col(SOURCE).alias("_source"), F.col("day").alias("_day"), F.col("chance").alias("_chance"))
        j = own.join(network, own[SOURCE].eqNullSafe(F.col("_source")) & (own["day"] == F.col("_day")))
        p = (F.col("chance") * F.col("n") + F.col("_chance") * prior) / (F.col("n") + prior)
        one = j.groupBy(SOURCE).agg(
            F.sum("open").alias("open_transactions"), F.round(F.sum(p * F.col("open")), 4).alias("expected_approvals"),
            F.sum("later").alias("approvals_that_came")).select(F.lit(as_of).alias("as_of_date"), "*")
        out = one if out is None else out.unionByName(one)
    return out
