"""The three raw inputs, either from feed CSVs or derived from the driver tables.

The adapter turns ``customer``/``part`` into an identity map, ``lineitem`` into a
coupon event feed and ``orders`` into a cashback feed, injecting the defects the
pipeline must survive (unmapped and ambiguous ids, replays, conflicting
payloads, cross-network copies, unknown statuses, impossible decision dates).
Every table is read in full; each derivation is one scan and a projection.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsekit.sources.feeds import read_identity_map, read_coupon_activity, read_cashback


@dataclass
class RawInputs:
    identity: DataFrame
    coupons: DataFrame
    cashback: DataFrame


def csv_inputs(spark: SparkSession, folder: str) -> RawInputs:
    return RawInputs(
        read_identity_map(spark, os.path.join(folder, "identity_map.csv")),
        read_coupon_activity(spark, os.path.join(folder, "coupon_activity.csv")),
        read_cashback(spark, os.path.join(folder, "cashback_transactions.csv")),
    )


def _s(prefix: str, c) -> "F.Column":
    return F.concat(F.lit(prefix), c.cast("string"))


def adapter_identity(customer: DataFrame, part: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    # one scan of customer: its mapped row and, for some ids, a second (ambiguous) row
    cust = customer.select(F.inline(F.filter(F.array(
        F.when(c % 50 != 7, F.struct(F.when(c % 60 == 13, " CashBack ").otherwise("cashback").alias("source_system"),
                                     F.when(c % 70 == 17, _s(" B", c)).otherwise(_s("B", c)).alias("source_user_id"),
                                     _s("U", c).alias("unified_user_id"))),
        F.when(c % 97 == 3, F.struct(F.lit("cashback").alias("source_system"),
                                     _s("B", c).alias("source_user_id"),
                                     _s("U", c + 1).alias("unified_user_id"))),
        F.when(c % 211 == 5, F.struct(F.lit("cashback").alias("source_system"), _s("N", c).alias("source_user_id"),
                                      F.lit(None).cast("string").alias("unified_user_id"))),       # no person
        F.when(c % 199 == 9, F.struct(F.lit("loyalty").alias("source_system"), _s("L", c).alias("source_user_id"),
                                      _s("U", c).alias("unified_user_id"))),                       # unknown system
    ), lambda x: x.isNotNull())))
    n_customers = customer.select(F.count(F.lit(1))).scalar()
    p = F.col("p_partkey")
    parts = part.filter(p % 60 != 11).select(
        F.lit("coupon").alias("source_system"), _s("C", p).alias("source_user_id"),
        _s("U", p % n_customers).alias("unified_user_id"))
    return cust.unionByName(parts)


def adapter_coupons(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.when(F.col("l_orderkey") % 150 == 21, " ").otherwise(""), F.col("l_orderkey").cast("string"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("coupon_event_id"),
        _s("C", F.col("l_partkey")).alias("coupon_user_id"),
        F.col("l_shipdate").cast("date").alias("event_date"),
        _s("M", F.col("l_suppkey")).alias("merchant_id"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), "coupon_copy")
         .otherwise("coupon_view").alias("event_type"),
    )


def adapter_cashback(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    ordered = F.col("o_orderdate").cast("date")
    d = F.when(k % 1100 != 9, ordered)                                             # some rows have no date
    status = (F.when(k % 500 == 3, "validated")
              .when((F.col("o_orderstatus") == "F") & (k % 140 == 19), " APPROVED")
              .when(F.col("o_orderstatus") == "F", "approved")
              .when(F.col("o_orderstatus") == "P", "pending")
              .when(k % 2 == 0, "rejected").otherwise("cancelled"))
    open_ = F.col("o_orderstatus") == "P"
    updated = (F.when(open_ & (k % 200 == 13), F.date_add(ordered, 3))             # pending, yet decided
               .when(open_ | (k % 900 == 11), F.lit(None).cast("date"))            # decided, yet undated
               .when(k % 700 == 4, F.date_sub(ordered, 1))
               .otherwise(F.date_add(ordered, (k % 90).cast("int"))))
    amount = F.col("o_totalprice").cast("decimal(38,9)")
    # one scan of orders; each order yields its row plus the injected copies, by number: the values are made once
    # for each row that comes out, in generated code, and not for arrays of whole rows
    base, replay, conflict, cross = range(4)
    copies = F.array(F.lit(base), F.when(k % 100 == 0, replay), F.when(k % 250 == 1, conflict), F.when(k % 300 == 2, cross))
    c = F.col("_copy")
    tid = (F.when(c == cross, _s("X", k)).when(c == conflict, _s("T", k))
           .when(k % 130 == 17, F.concat(_s(" T", k), F.lit("  "))).otherwise(_s("T", k)))
    return orders.select("*", F.explode(copies).alias("_copy")).filter(c.isNotNull()).select(
        tid.alias("transaction_id"), _s("B", F.col("o_custkey")).alias("cashback_user_id"),
        d.alias("purchase_date"), _s("M", k % 20).alias("merchant_id"),
        F.when(c == cross, "9-OTHER").otherwise(F.col("o_orderpriority")).alias("source"), status.alias("status"),
        updated.alias("status_updated_date"),
        F.when(c == conflict, (amount + 1).cast("decimal(38,9)")).otherwise(amount).alias("amount_sar"))


def adapter_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    rd = lambda t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
    return RawInputs(
        adapter_identity(rd("customer"), rd("part")),
        adapter_coupons(rd("lineitem")),
        adapter_cashback(rd("orders")),
    )


# ---- external inputs for the reconciliation / type-2 analyses (derived from the same tables) ----
def adapter_external_counts(orders: DataFrame) -> DataFrame:
    """Customers with an order per quarter, as an independent count to reconcile against."""
    d = F.col("o_orderdate").cast("date")
    return (orders.groupBy(F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
                           .alias("quarter_label"))
            .agg(F.count_distinct("o_custkey").alias("external_count"))
            .select("quarter_label", F.lit("order_customers").alias("external_source"), "external_count"))


def adapter_network_reports(orders: DataFrame) -> DataFrame:
    """Each network's own report: transactions and amount per purchase quarter, straight from the orders."""
    d = F.col("o_orderdate").cast("date")
    return (orders.groupBy(F.col("o_orderpriority").alias("source"),
                           F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
                           .alias("quarter_label"))
            .agg(F.count(F.lit(1)).alias("reported_transactions"),
                 F.sum(F.col("o_totalprice").cast("decimal(38,9)")).alias("reported_amount_sar")))


def adapter_identity_scd2(customer: DataFrame, part: DataFrame, switch: "dt.date") -> DataFrame:
    """Type-2 identity map: ids that move to a second person do so on ``switch``; for some of
    them the first range runs on for 30 days beside the second (an overlap in the source)."""
    c = F.col("c_custkey")
    none = F.lit(None).cast("date")
    moved = c % 97 == 3
    cust = customer.filter(c % 50 != 7).select(F.inline(F.filter(F.array(
        F.struct(F.lit("cashback").alias("source_system"), _s("B", c).alias("source_user_id"),
                 _s("U", c).alias("unified_user_id"), none.alias("valid_from"),
                 F.when(c % 194 == 100, F.date_add(F.lit(switch), 29))
                 .when(moved, F.date_sub(F.lit(switch), 1)).alias("valid_to")),
        F.when(moved, F.struct(F.lit("cashback").alias("source_system"), _s("B", c).alias("source_user_id"),
                               _s("U", c + 1).alias("unified_user_id"), F.lit(switch).alias("valid_from"),
                               none.alias("valid_to")))), lambda x: x.isNotNull())))
    n_customers = customer.select(F.count(F.lit(1))).scalar()
    p = F.col("p_partkey")
    parts = part.filter(p % 60 != 11).select(
        F.lit("coupon").alias("source_system"), _s("C", p).alias("source_user_id"),
        _s("U", p % n_customers).alias("unified_user_id"), none.alias("valid_from"), none.alias("valid_to"))
    return cust.unionByName(parts)


def adapter_identity_bitemporal(customer: DataFrame, part: DataFrame, entered: "dt.date") -> DataFrame:
    """A map on two time axes: some ids are merged into another person on ``entered``, with effect from the start
    (history is restated); others move from that day on; one in 150 is entered only then."""
    c, none, day = F.col("c_custkey"), F.lit(None).cast("date"), F.lit(entered)
    merged, moved, late = c % 31 == 4, c % 37 == 6, c % 150 == 8

    def row(person, valid_from, valid_to, known_from, known_to):
        return F.struct(F.lit("cashback").alias("source_system"), _s("B", c).alias("source_user_id"), _s("U", person).alias("unified_user_id"),
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"), known_from.alias("known_from"), known_to.alias("known_to"))

    yesterday = F.date_sub(day, 1)
    cust = customer.select(F.inline(F.filter(F.array(
        F.when(~merged & ~moved & ~late, row(c, none, none, none, none)),
        F.when(merged, row(c, none, none, none, yesterday)), F.when(merged, row(c + 1, none, none, day, none)),
        F.when(moved & ~merged, row(c, none, none, none, yesterday)),
        F.when(moved & ~merged, row(c, none, yesterday, day, none)), F.when(moved & ~merged, row(c + 1, day, none, day, none)),
        F.when(late & ~merged & ~moved, row(c, none, none, day, none))), lambda x: x.isNotNull())))
    parts = part.select(F.lit("coupon").alias("source_system"), _s("C", F.col("p_partkey")).alias("source_user_id"),
                        _s("U", F.col("p_partkey")).alias("unified_user_id"), none.alias("valid_from"), none.alias("valid_to"),
                        none.alias("known_from"), none.alias("known_to"))
    return cust.unionByName(parts)


def adapter_network_feeds(orders: DataFrame) -> dict:
    """Two networks with feeds of their own design, which share no column (for S4): 'harbor' has
    the small orders (up to 150,000), with the moment of sale in UTC and amounts as numbers; 'quill' the
    rest, with days as yyyyMMdd text and amounts in cents. Together they cover every order."""
    from lapsekit.sources.feeds import FeedSpec
    k, st, price = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    outcome = lambda f, p, other: F.when(st == "F", f).when(st == "P", p).otherwise(other)
    harbor = orders.filter(price <= 150_000).select(
        _s("T", k).alias("order_no"), _s("B", F.col("o_custkey")).alias("shopper"),
        (F.col("o_orderdate") + F.make_interval(hours=(k % 24).cast("int"))).alias("sold_at_utc"),
        _s("M", k % 20).alias("store_code"), outcome("Settled ", "in review", "Void").alias("outcome"), price.alias("gross"))
    quill = orders.filter(price > 150_000).select(
        _s(" T", k).alias("ref"), _s("B", F.col("o_custkey")).alias("card"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day_text"), _s("M", k % 20).alias("partner"),
        outcome("cleared", "held", "reversed").alias("result"), F.round(price * 100).cast("long").alias("cents"))
    return {
        "harbor": (harbor, FeedSpec("Harbor", {
            "transaction_id": "order_no", "cashback_user_id": "shopper", "purchase_date": "sold_at_utc",
            "merchant_id": "store_code", "status": "outcome", "amount_sar": "gross"},
            {"settled": "approved", "in review": "pending", "void": "rejected"}, timezone="America/Lima")),
        "quill": (quill, FeedSpec("Quill", {
            "transaction_id": F.trim("ref"), "cashback_user_id": "card", "purchase_date": F.to_date("day_text", "yyyyMMdd"),
            "merchant_id": "partner", "status": "result", "amount_sar": F.col("cents").cast("decimal(38,9)") / 100},
            {"cleared": "approved", "held": "pending", "reversed": "cancelled"})),
    }


def adapter_event_stream_inputs(events: DataFrame) -> RawInputs:
    """The ``events`` table as a single-channel activity feed for a weekly-grain
    model: every user is a person (identity map = the distinct users), every
    event a coupon-channel event, and a purchase is the eligible activity."""
    from lapsekit.sources.feeds import CASHBACK_SCHEMA
    spark = events.sparkSession
    u = F.col("user_id")
    identity = events.select(u).distinct().select(
        F.lit("coupon").alias("source_system"), _s("E", u).alias("source_user_id"), _s("U", u).alias("unified_user_id"))
    coupons = events.select(
        _s("EV", F.col("event_id")).alias("coupon_event_id"), _s("E", u).alias("coupon_user_id"),
        F.col("ts").cast("date").alias("event_date"), F.col("event_type").alias("merchant_id"),
        F.when(F.col("event_type") == "purchase", "coupon_copy").otherwise(F.col("event_type")).alias("event_type"))
    return RawInputs(identity, coupons, spark.createDataFrame([], CASHBACK_SCHEMA))
