"""Analyses the model calls for beyond its SQL (E01-E16): hazard curve,
revenue back-test, restatement magnitude, external reconciliation, rolling
windows, reporting lag, feed continuity, vocabulary drift, identity coverage,
late arrival, type-2 identity, financial reconciliation, expected approvals of
undecided rows, parameterised cohorts and quarter-boundary exposure.

All are compositions of built-in DataFrame operators; the windows run over the
dense person x period table (every window partition holds exactly one row per
period) or over small per-network series.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsekit.functions.periods import period_end, period_label, period_start, periods_of
from lapsekit.functions.rates import rate
from lapsekit.spec import ALL_SOURCES_LABEL, APPROVED, ChurnSpec, DEFAULT_SPEC

ALL_COHORTS = "ALL COHORTS"


# E01 ---------------------------------------------------------------------------------
def hazard_curve(long: DataFrame) -> DataFrame:
    """P(return | n silent periods): for every activity episode (a person's last
    active period = cohort) that has stayed silent n periods with period n+1
    observable, the share that is active again in period n+1. Per cohort period
    and pooled over cohorts (``ALL COHORTS``)."""
    w = Window.partitionBy("definition_name", "unified_user_id").orderBy("quarter_index")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = F.col("is_active")
    rows = long.select(
        "definition_name", "quarter_index", a,
        F.max(F.when(a, F.col("quarter_index"))).over(upto).alias("_last"),
        F.last(F.when(a, F.col("quarter_label")), ignorenulls=True).over(upto).alias("cohort_quarter"),
        F.lead(a).over(w).alias("_next"))
    silent = rows.filter(~a & F.col("_last").isNotNull() & F.col("_next").isNotNull()).select(
        "definition_name", "cohort_quarter", (F.col("quarter_index") - F.col("_last")).alias("silent_periods"),
        "_next")
    g = silent.rollup("definition_name", "silent_periods", "cohort_quarter").agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("at_risk_users"),
        F.count_if(F.col("_next")).alias("returned_users"))
    return g.filter(F.col("_gid") <= 1).select(
        "definition_name",
        F.when(F.col("_gid") == 1, F.lit(ALL_COHORTS)).otherwise(F.col("cohort_quarter")).alias("cohort_quarter"),
        F.col("silent_periods").cast("long").alias("silent_periods"), "at_risk_users", "returned_users",
        rate("returned_users", "at_risk_users").alias("return_rate"))


def confirmation_horizon(hazard: DataFrame, materiality: float = 0.05) -> DataFrame:
    """Smallest number of silent periods after which the pooled return rate drops
    below ``materiality`` (per definition; NULL when never)."""
    pooled = hazard.filter(F.col("cohort_quarter") == ALL_COHORTS)
    return pooled.groupBy("definition_name").agg(
        F.min(F.when(F.col("return_rate") < materiality, F.col("silent_periods"))).alias("confirm_after_periods"))


# E02 ---------------------------------------------------------------------------------
def revenue_backtest(fact: DataFrame, transitions: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """For each cohort period c and horizon k: realised active users and approved
    amount of the cohort k periods later, against the prediction of the
    period-to-period retention curve (cohort x product of retention rates)."""
    ps = periods_of(spec.period_start, spec.period_end, spec.grain)
    P = len(ps)
    flags = []
    for d in spec.definitions:
        for i in range(1, P + 1):
            here = F.col("quarter_index") == i
            flags += [F.coalesce(F.bool_or(here & F.col(f"is_active_{d.name}")), F.lit(False)).alias(f"a_{d.name}_{i}")]
    amts = [F.sum(F.when(F.col("quarter_index") == i, F.col("approved_amount_sar"))).alias(f"m_{i}")
            for i in range(1, P + 1)]
    per_user = fact.groupBy("unified_user_id").agg(*flags, *amts)
    combos = [(d.name, c, k) for d in spec.definitions for c in range(1, P + 1) for k in range(1, P - c + 1)]
    gen = F.inline(F.array(*[F.struct(
        F.lit(dn).alias("definition_name"), F.lit(c).alias("c"), F.lit(k).alias("k"),
        F.col(f"a_{dn}_{c}").alias("in_cohort"), F.col(f"a_{dn}_{c + k}").alias("active_k"),
        F.col(f"m_{c}").alias("amount_c"), F.col(f"m_{c + k}").alias("amount_k")) for dn, c, k in combos]))
    rows = per_user.select(gen).filter(F.col("in_cohort"))
    g = rows.groupBy("definition_name", "c", "k").agg(
        F.count(F.lit(1)).alias("cohort_users"), F.count_if(F.col("active_k")).alias("realised_active_users"),
        F.coalesce(F.sum("amount_c"), F.lit(0).cast("decimal(38,9)")).alias("cohort_amount_sar"),
        F.coalesce(F.sum("amount_k"), F.lit(0).cast("decimal(38,9)")).alias("realised_amount_sar"))
    idx = {p.label: p.index for p in ps}
    imap = F.create_map(*[F.lit(x) for kv in idx.items() for x in kv])
    curve = transitions.groupBy("definition_name").agg(F.collect_list(F.struct(
        imap[F.col("from_quarter")].alias("i"), F.col("next_quarter_retention_rate").alias("r"))).alias("curve"))
    j = g.join(F.broadcast(curve), "definition_name", "left")  # one row per definition
    prod = F.aggregate(F.filter("curve", lambda x: (x["i"] >= F.col("c")) & (x["i"] < F.col("c") + F.col("k"))),
                       F.lit(1.0), lambda acc, x: acc * x["r"])
    lab = F.create_map(*[F.lit(x) for p in ps for x in (p.index, p.label)])
    return j.select(
        "definition_name", lab[F.col("c")].alias("cohort_quarter"), F.col("k").cast("long").alias("periods_ahead"),
        "cohort_users", "realised_active_users",
        F.round(F.col("cohort_users") * prod, 4).alias("predicted_active_users"),
        "cohort_amount_sar", "realised_amount_sar",
        F.round(F.col("cohort_amount_sar").cast("double") * prod, 4).alias("predicted_amount_sar"))


# E03 ---------------------------------------------------------------------------------
def restatement_magnitude(vintage_base: DataFrame) -> DataFrame:
    """Mean absolute change of a period's active base between T+0 and T+k, over
    measured periods, per definition and k (in users and as a rate of T+0).
    ``vintage_base`` is the dense grid of periods and lags
    (``active_base_by_vintage(..., dense=True)``): a base that falls to 0 is the
    largest restatement of all, not a missing row."""
    lag0 = F.max(F.when(F.col("vintage_days") == 0, F.col("active_users")))
    at_lags = F.collect_list(F.struct("vintage_days", "active_users"))   # one entry a lag: bounded by the parameters
    g = vintage_base.groupBy("measured_quarter", "definition_name").agg(lag0.alias("_t0"), at_lags.alias("_v"))
    j = g.select("definition_name", "_t0", F.inline("_v")).filter("vintage_days > 0").withColumn(
        "_d", F.abs(F.col("active_users") - F.col("_t0")))
    m = j.groupBy("definition_name", "vintage_days").agg(
        F.count(F.lit(1)).alias("measured_quarters"), F.avg("_d").alias("_m"),
        F.avg(F.try_divide(F.col("_d").cast("double"), F.col("_t0").cast("double"))).alias("_r"))
    return m.select("definition_name", "vintage_days", "measured_quarters",
                    F.round("_m", 4).alias("mean_abs_restatement_users"),
                    F.round("_r", 4).alias("mean_abs_restatement_rate"))


# E04 ---------------------------------------------------------------------------------
def reconcile_active_base(active_base: DataFrame, external: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                          tolerance: float = 0.05) -> DataFrame:
    """Active base (primary definition) against external counts
    (quarter_label, external_source, external_count); full outer join per period."""
    ab = active_base.filter(F.col("definition_name") == spec.primary.name).select("quarter_label", "active_users")
    j = ab.join(external, "quarter_label", "full_outer")
    delta = F.col("active_users") - F.col("external_count")
    r = rate(delta, F.col("external_count"))
    return j.select(
        "quarter_label", "external_source", "active_users", "external_count", delta.alias("delta"),
        r.alias("delta_rate"),
        F.when(F.col("active_users").isNull() | F.col("external_count").isNull(), "MISSING")
        .when(F.abs(r) <= tolerance, "OK").otherwise("MISMATCH").alias("status"))


# E05 ---------------------------------------------------------------------------------
def rolling_activity(long: DataFrame, n: int = 4) -> DataFrame:
    """Active in any of the last ``n`` periods (a rolling window), per definition
    and period, next to the point-in-period base. ``observed_periods`` tells how many
    periods of the window lie in the range: with fewer than ``n`` the count is partial
    (``is_full_window`` false) and not to be compared with full ones."""
    w = (Window.partitionBy("definition_name", "unified_user_id").orderBy("quarter_index")
         .rowsBetween(-(n - 1), Window.currentRow))
    r = long.select("definition_name", "quarter_label", "quarter_index", "is_active",
                    F.coalesce(F.bool_or("is_active").over(w), F.lit(False)).alias("_rolling"))
    return r.groupBy("definition_name", "quarter_label", "quarter_index").agg(
        F.lit(n).cast("long").alias("window_periods"),
        F.count_if("is_active").alias("point_active_users"),
        F.count_if("_rolling").alias("rolling_active_users")).withColumns({
            "observed_periods": F.least(F.col("quarter_index"), F.lit(n).cast("long")).cast("long"),
            "is_full_window": F.col("quarter_index") >= n})


# E06 ---------------------------------------------------------------------------------
def reporting_lag(curve: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Smallest horizon with decided share >= threshold per network and overall;
    ``is_worst_source`` marks the network that needs the longest lag (a network
    that never reaches the threshold within the horizons is the worst)."""
    g = curve.groupBy("source").agg(
        F.min(F.when(F.col("decided_share") >= threshold, F.col("horizon_days"))).cast("long").alias("lag_days"))
    rank = F.when(F.col("source") != ALL_SOURCES_LABEL, F.coalesce("lag_days", F.lit(10 ** 9)))
    ranked = g.withColumn("_r", rank).withColumn("_worst", F.max("_r").over(Window.partitionBy()))  # one row a source
    return ranked.select(
        F.when(F.col("source") == ALL_SOURCES_LABEL, "overall").otherwise("source").alias("scope"),
        "source", "lag_days", F.col("lag_days").isNotNull().alias("reaches_threshold"),
        F.coalesce(F.col("_r") == F.col("_worst"), F.lit(False)).alias("is_worst_source"))


# E07 ---------------------------------------------------------------------------------
def feed_continuity(profile: DataFrame, n: int = 4, threshold: float = 0.5) -> DataFrame:
    """Each network's volume against its own trailing ``n``-period average (dense
    series, so a silent period is a 0, not a gap). Alerts: a deviation of more than
    ``threshold``; any silent period after the feed has once had volume, however long
    it has been silent; and volume that returns after ``n`` silent periods."""
    p = profile.filter(F.col("quarter_label").isNotNull())
    by = Window.partitionBy("source").orderBy("quarter_label")
    r = p.select("source", "quarter_label", "transactions",
                 F.round(F.avg("transactions").over(by.rowsBetween(-n, -1)), 4).alias("trailing_avg_transactions"),
                 F.coalesce(F.max("transactions").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                 .alias("_before"))
    v, avg = F.col("transactions"), F.col("trailing_avg_transactions")
    dev = rate(v - avg, avg)
    dead, back = (v == 0) & (F.col("_before") > 0), (v > 0) & (avg == 0) & (F.col("_before") > 0)
    return r.select("source", "quarter_label", "transactions", "trailing_avg_transactions", dev.alias("deviation"),
                    F.coalesce((F.abs(dev) > threshold) | dead | back, F.lit(False)).alias("is_alert"))


# E08 ---------------------------------------------------------------------------------
def status_vocabulary(txns: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Every status word per network with its volume; unknown words are flagged
    (they must fail loudly, never silently stop counting)."""
    known = [s for s, _ in spec.status_classes]
    return txns.groupBy("source", "status").agg(F.count(F.lit(1)).alias("transactions")).select(
        "source", "status", "transactions",
        F.coalesce(F.col("status").isin(*known), F.lit(False)).alias("is_known"))


# E09 ---------------------------------------------------------------------------------
def identity_coverage(events: DataFrame) -> DataFrame:
    """Unmapped source-id rate per channel, feed and period."""
    key = ["channel", "source_feed", "quarter_label"]
    ids = events.groupBy(*key, "source_user_id").agg(           # one row a source id: no distinct counts, no Expand
        F.count(F.lit(1)).alias("n"), F.count_if("is_unmapped_user").alias("u"))
    known = F.col("source_user_id").isNotNull()
    g = ids.groupBy(*key).agg(
        F.sum("n").alias("rows"), F.sum("u").alias("unmapped_rows"), F.count_if(known).alias("source_ids"),
        F.count_if(known & (F.col("u") > 0)).alias("unmapped_source_ids"))
    return g.select("*", rate("unmapped_rows", "rows").alias("unmapped_row_rate"),
                    rate("unmapped_source_ids", "source_ids").alias("unmapped_id_rate"))


# E10 ---------------------------------------------------------------------------------
def late_arrival(txns: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Per network and purchase period: transactions not settled by period close
    (decided after the close, or still undecided) and their share."""
    g = spec.grain
    end = period_end(period_start("purchase_date", g), g)
    upd = F.col("status_updated_date")
    agg = txns.groupBy("source", period_label("purchase_date", g).alias("quarter_label")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(upd > end).alias("decided_after_close"),
        F.count_if(upd.isNull()).alias("undecided"))
    return agg.select("*", rate(F.col("decided_after_close") + F.col("undecided"), F.col("transactions"))
                      .alias("late_share"))


# E12 ---------------------------------------------------------------------------------
def disjoint_identity(identity_scd2: DataFrame) -> DataFrame:
    """A type-2 identity map (source_system, source_user_id, unified_user_id,
    valid_from, valid_to, both inclusive, NULL for open) cut into ranges that do not
    overlap: (source_system, source_user_id, unified_user_id, valid_from, valid_before,
    has_ambiguous_mapping), half-open. Where ranges of different persons overlap, the
    smallest person id is taken and the range is flagged, as in the plain map."""
    low, high = F.to_date(F.lit("0001-01-01")), F.to_date(F.lit("9999-12-31"))
    r = identity_scd2.filter("source_system IS NOT NULL AND source_user_id IS NOT NULL").select(
        "source_system", "source_user_id", "unified_user_id", F.coalesce("valid_from", low).alias("f"),
        F.coalesce(F.date_add("valid_to", 1), high).alias("b")).filter("f < b")
    key = ["source_system", "source_user_id"]
    w = Window.partitionBy(*key).orderBy("at")
    cuts = (r.select(*key, F.explode(F.array("f", "b")).alias("at")).distinct()
            .select(*key, F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_before"))
            .filter("valid_before IS NOT NULL"))
    parts = cuts.join(r, key).filter((F.col("f") <= F.col("valid_from")) & (F.col("b") >= F.col("valid_before")))
    return parts.groupBy(*key, "valid_from", "valid_before").agg(
        F.min("unified_user_id").alias("unified_user_id"),
        (F.min("unified_user_id") != F.max("unified_user_id")).alias("has_ambiguous_mapping"))


def identity_overlaps(identity_scd2: DataFrame) -> DataFrame:
    """Check: days on which a source id maps to several persons, per source system."""
    d = disjoint_identity(identity_scd2).filter("has_ambiguous_mapping")
    return d.groupBy("source_system").agg(F.count_distinct("source_user_id").alias("overlapping_ids"),
                                          F.sum(F.datediff("valid_before", "valid_from")).alias("overlapping_days"))


def resolve_identity_scd2(channel_events: DataFrame, identity_scd2: DataFrame) -> DataFrame:
    """Resolve source ids through a type-2 identity map: the mapping valid on the
    activity date wins. Equi-join on the key with the map's disjoint ranges, so an event
    comes out exactly once; an event on a day that overlapping ranges claim for
    different persons is flagged ambiguous (and so out of scope, as in the model)."""
    m = disjoint_identity(identity_scd2).select(
        F.col("source_system").alias("_s"), F.col("source_user_id").alias("_id"), "unified_user_id", "valid_from",
        "valid_before", "has_ambiguous_mapping")
    cond = ((channel_events["channel"] == m["_s"]) & (channel_events["source_user_id"] == m["_id"])
            & (F.col("activity_date") >= F.col("valid_from")) & (F.col("activity_date") < F.col("valid_before")))
    j = channel_events.join(m, cond, "left")
    return j.select("channel", "source_event_id", "source_user_id", "activity_date", "unified_user_id",
                    F.col("unified_user_id").isNull().alias("is_unmapped_user"),
                    F.coalesce("has_ambiguous_mapping", F.lit(False)).alias("has_ambiguous_mapping"))


# E13 ---------------------------------------------------------------------------------
def financial_reconciliation(txns: DataFrame, reported: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Our staged counts and amounts per network and period against the network's
    own report (source, quarter_label, reported_transactions, reported_amount_sar)."""
    ours = txns.groupBy("source", period_label("purchase_date", spec.grain).alias("quarter_label")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount_sar").alias("amount_sar"))
    o, r = ours.alias("o"), reported.alias("r")
    j = o.join(r, [F.col("o.source").eqNullSafe(F.col("r.source")),
                   F.col("o.quarter_label").eqNullSafe(F.col("r.quarter_label"))], "full_outer")
    return j.select(
        F.coalesce("o.source", "r.source").alias("source"),
        F.coalesce("o.quarter_label", "r.quarter_label").alias("quarter_label"),
        F.col("o.transactions").alias("transactions"), F.col("r.reported_transactions").alias("reported_transactions"),
        (F.col("o.transactions") - F.col("r.reported_transactions")).alias("transaction_delta"),
        F.col("o.amount_sar").alias("amount_sar"), F.col("r.reported_amount_sar").alias("reported_amount_sar"),
        (F.col("o.amount_sar") - F.col("r.reported_amount_sar")).cast("decimal(38,9)").alias("amount_delta"))


# E14 ---------------------------------------------------------------------------------
def expected_approvals(txns: DataFrame, as_of: dt.date, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Apply the maturity curve to rows undecided on ``as_of``: a row of age a
    (days since purchase) falls in the age band [h_i, h_i+1) of the horizons
    (0 first); its approval probability is the approval rate of the network's
    transactions decided later than h_i days. Every decided row feeds each band
    it outlived (a bounded explode), so the curve is one aggregate and the rows
    meet it by an equi-join on (network, band)."""
    bands = sorted({0, *spec.horizons})
    age = F.datediff(F.lit(as_of), F.col("purchase_date"))
    band_of = lambda c: F.element_at(F.filter(F.array(*[F.lit(b) for b in reversed(bands)]),
                                              lambda b: b <= c), 1)
    decided = txns.filter(F.col("status_updated_date").isNotNull() & (F.col("status_updated_date") <= F.lit(as_of)))
    curve = (decided.select("source", "status", F.explode(F.filter(F.array(*[F.lit(b) for b in bands]),
                                                                    lambda b: F.col("days_to_status_decision") > b))
                            .alias("band"))
             .groupBy("source", "band").agg(F.count(F.lit(1)).alias("_n"),
                                             F.count_if(F.col("status") == APPROVED).alias("_a"))
             .select("source", "band", F.try_divide(F.col("_a").cast("double"), F.col("_n").cast("double"))
                     .alias("p_approve")))
    undecided = txns.filter((F.col("purchase_date") <= F.lit(as_of)) & (
        F.col("status_updated_date").isNull() | (F.col("status_updated_date") > F.lit(as_of))))
    u = undecided.groupBy("source", band_of(age).alias("band")).agg(    # a few rows a source before the join
        F.count(F.lit(1)).alias("n"), F.sum("amount_sar").alias("amount"))
    j = u.join(curve, ["source", "band"], "left")
    p = F.coalesce("p_approve", F.lit(0.0))
    return j.groupBy("source").agg(
        F.sum("n").alias("undecided_transactions"),
        F.round(F.sum(p * F.col("n")), 4).alias("expected_approvals"),
        F.round(F.sum(p * F.coalesce(F.col("amount").cast("double"), F.lit(0.0))), 2)
        .alias("expected_approved_amount_sar"),
        F.coalesce(F.sum(F.when(F.col("p_approve").isNull(), F.col("n"))), F.lit(0)).alias("rows_without_curve"))


# E16 ---------------------------------------------------------------------------------
def boundary_exposure(txns: DataFrame, days: int = 7, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Transactions dated within ``days`` of their period's end, per network and
    period (the rows a timezone shift can move across the boundary)."""
    g = spec.grain
    end = period_end(period_start("purchase_date", g), g)
    near = F.datediff(end, F.col("purchase_date")) < days
    agg = txns.groupBy("source", period_label("purchase_date", g).alias("quarter_label")).agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(near).alias("near_boundary_transactions"))
    return agg.select("*", rate("near_boundary_transactions", "transactions").alias("near_boundary_share"))
