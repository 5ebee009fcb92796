"""Layer 7b: as-of restatement (M20), many reporting dates in one pass (M20b),
transition churn by vintage (M21) and active base by vintage (M22).

A transaction whose decision had not happened by the as-of date is treated as
pending, exactly as the extract showed it then. Many dates are handled by one
conditional column per date in a single aggregate per person and period, which is
turned into rows afterwards: the events are read once and never multiplied.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.periods import periods_of
from lapsekit.functions.rates import rate
from lapsekit.operators.events import activity_col
from lapsekit.spec import COUPON, PENDING, ChurnSpec, DEFAULT_SPEC


@dataclass(frozen=True)
class Vintage:
    days: int                    # lag after the measured period's close
    as_of: dt.date
    measured: str | None = None  # period label measured at this vintage (None = all)

    @property
    def label(self) -> str:
        return f"T+{self.days}"


def _scope(events: DataFrame) -> DataFrame:
    return events.filter(F.col("is_in_scope") & F.col("unified_user_id").isNotNull())


def counts_as_of(as_of: Column, spec: ChurnSpec) -> dict[str, Column]:
    """Per definition: does the event count as activity as known on ``as_of``?"""
    upd = F.col("status_updated_date")
    status = F.when(upd.isNull() | (upd > as_of), F.lit(PENDING)).otherwise(F.col("event_or_status"))
    out = {}
    for d in spec.definitions:
        out[d.name] = F.coalesce(
            F.when(F.col("channel") == COUPON, F.col(activity_col(d))).otherwise(status.isin(*d.cashback_statuses)),
            F.lit(False))
    return out


def activity_as_of(events: DataFrame, as_of: dt.date, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Sparse person x period activity as it looked on ``as_of``
    (as_of_date, unified_user_id, quarter_label, is_active_<definition>...)."""
    a = F.lit(as_of)
    c = counts_as_of(a, spec)
    ev = _scope(events).filter(F.col("activity_date") <= a)
    return ev.groupBy("unified_user_id", "quarter_label").agg(
        *[F.bool_or(c[d.name]).alias(f"is_active_{d.name}") for d in spec.definitions]
    ).select(a.alias("as_of_date"), "unified_user_id", "quarter_label",
             *[f"is_active_{d.name}" for d in spec.definitions])


def activity_as_of_many(events: DataFrame, vintages: list[Vintage], spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """M20 for many dates in one pass. The events are aggregated once per person and
    period with one conditional column per vintage slot and definition (NULL: no event by
    that date); the slots become rows only after the aggregate, so no event is multiplied.
    A vintage with ``measured`` set only sees its period; the vintages of one period share
    the slots of the others (slot k of every period is its k-th vintage)."""
    labels = sorted({v.measured for v in vintages if v.measured is not None})
    every = [v for v in vintages if v.measured is None]
    own = {q: [v for v in vintages if v.measured == q] for q in labels}
    q = F.col("quarter_label")

    def of_period(k: int, value, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for label in labels:
            if k < len(own[label]):
                out = F.when(q == label, F.lit(value(own[label][k])).cast(kind)).otherwise(out)
        return out

    slots = [(F.lit(v.days), F.lit(v.as_of), F.lit(None).cast("string")) for v in every]
    slots += [(of_period(k, lambda v: v.days, "int"), of_period(k, lambda v: v.as_of, "date"),
               of_period(k, lambda v: v.measured, "string")) for k in range(max(map(len, own.values()), default=0))]
    aggs = []
    for k, (_, as_of, _) in enumerate(slots):
        seen, c = F.col("activity_date") <= as_of, counts_as_of(as_of, spec)
        aggs += [F.bool_or(F.when(seen, c[d.name])).alias(f"s{k}_{d.name}") for d in spec.definitions]
    ev = _scope(events)
    if not every:
        ev = ev.filter(q.isin(*labels))
    per = ev.groupBy("unified_user_id", "quarter_label").agg(*aggs)
    rows = per.select("unified_user_id", "quarter_label", F.inline(F.array(*[
        F.struct(days.alias("vintage_days"), as_of.alias("as_of_date"), measured.alias("measured_quarter"),
                 *[F.col(f"s{k}_{d.name}").alias(f"is_active_{d.name}") for d in spec.definitions])
        for k, (days, as_of, measured) in enumerate(slots)])))
    return rows.filter(F.col(f"is_active_{spec.definitions[0].name}").isNotNull()).select(
        "vintage_days", "as_of_date", "measured_quarter", "unified_user_id", "quarter_label",
        *[f"is_active_{d.name}" for d in spec.definitions])


def period_vintages(spec: ChurnSpec = DEFAULT_SPEC) -> list[Vintage]:
    """Every period measured at its own close + each lag."""
    return [Vintage(lag, p.end + dt.timedelta(days=lag), p.label)
            for p in periods_of(spec.period_start, spec.period_end, spec.grain) for lag in spec.vintage_lags]


def active_base_by_vintage(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, dense: bool = False) -> DataFrame:
    """Active users of every period as measured at T+lag from its own close
    (measured_quarter, vintage_label, vintage_days, as_of_date, definition_name, active_users).
    ``dense``: every period and lag, also those with no active user (M22 itself leaves them out)."""
    vintages = period_vintages(spec)
    per = activity_as_of_many(events, vintages, spec)
    per = per.filter(F.col("quarter_label") == F.col("measured_quarter"))
    g = per.groupBy("measured_quarter", "vintage_days", "as_of_date").agg(
        *[F.count_if(F.col(f"is_active_{d.name}")).alias(d.name) for d in spec.definitions])
    long = g.select("measured_quarter", "vintage_days", "as_of_date", F.inline(F.array(*[
        F.struct(F.lit(d.name).alias("definition_name"), F.col(d.name).alias("active_users"))
        for d in spec.definitions])))
    if dense:  # the grid of the parameters as rows of 0 beside the counts
        grid = events.sparkSession.createDataFrame(
            [(v.measured, v.days, v.as_of, d.name, 0) for v in vintages for d in spec.definitions],
            "measured_quarter string, vintage_days int, as_of_date date, definition_name string, active_users long")
        long = long.unionByName(grid).groupBy("measured_quarter", "vintage_days", "as_of_date", "definition_name").agg(
            F.sum("active_users").alias("active_users"))
    else:
        long = long.filter(F.col("active_users") > 0)
    return long.select(
        "measured_quarter", F.concat(F.lit("T+"), F.col("vintage_days").cast("string")).alias("vintage_label"),
        F.col("vintage_days").cast("long").alias("vintage_days"), "as_of_date", "definition_name",
        "active_users")


def transition_by_vintage(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, frm: int = 2, to: int = 3,
                          lags: tuple[int, ...] | None = None) -> DataFrame:
    """Churn of one transition (periods ``frm`` -> ``to``, 1-based) measured
    at T+lag after the close of the ``to`` period."""
    ps = periods_of(spec.period_start, spec.period_end, spec.grain)
    pf, pt = ps[frm - 1], ps[to - 1]
    lags = lags or spec.vintage_lags
    vs = [Vintage(lag, pt.end + dt.timedelta(days=lag)) for lag in lags]
    ev = _scope(events).filter(F.col("quarter_label").isin(pf.label, pt.label))
    per = activity_as_of_many(ev, vs, spec)
    q = F.col("quarter_label")
    users = per.groupBy("vintage_days", "as_of_date", "unified_user_id").agg(*[
        x for d in spec.definitions for x in (
            F.coalesce(F.bool_or((q == pf.label) & F.col(f"is_active_{d.name}")), F.lit(False)).alias(f"f_{d.name}"),
            F.coalesce(F.bool_or((q == pt.label) & F.col(f"is_active_{d.name}")), F.lit(False)).alias(f"t_{d.name}"))])
    long = users.select("vintage_days", "as_of_date", F.inline(F.array(*[
        F.struct(F.lit(d.name).alias("definition_name"), F.col(f"f_{d.name}").alias("a"),
                 F.col(f"t_{d.name}").alias("b")) for d in spec.definitions])))
    a, b = F.col("a"), F.col("b")
    g = long.groupBy("vintage_days", "as_of_date", "definition_name").agg(
        F.count_if(a).alias("active_base"), F.count_if(a & b).alias("retained_users"),
        F.count_if(a & ~b).alias("churned_users"))
    return g.select(
        F.concat(F.lit("T+"), F.col("vintage_days").cast("string")).alias("vintage_label"),
        F.col("vintage_days").cast("long").alias("vintage_days"), "as_of_date", "definition_name",
        F.lit(pf.label).alias("from_quarter"), F.lit(pt.label).alias("to_quarter"),
        "active_base", "retained_users", "churned_users",
        rate("churned_users", "active_base").alias("churn_rate"))
