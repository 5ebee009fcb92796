"""Layer 3: the dense person x period fact (M01, M06) and its definition view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsekit.functions.periods import period_end, period_index, periods_of
from lapsekit.operators.events import activity_col
from lapsekit.spec import (APPROVED, CASHBACK, COUPON, EXCLUDED_STATUSES, PENDING,
                           ChurnSpec, DEFAULT_SPEC)


def active_col(d) -> str:
    return f"is_active_{d.name}"


def period_spine(spark: SparkSession, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """quarter_label, quarter_start_date, quarter_end_date, quarter_index (1-based).

    Generated from the parameters (``sequence`` + ``posexplode``), no window."""
    step = {"quarter": "interval 3 months", "month": "interval 1 month", "week": "interval 7 days"}[spec.grain]
    first = periods_of(spec.period_start, spec.period_end, spec.grain)[0].start
    from lapsekit.functions.periods import period_label
    starts = spark.range(1).select(F.posexplode(F.sequence(
        F.lit(first), F.lit(spec.period_end), F.expr(step))).alias("pos", "quarter_start_date"))
    return starts.select(
        period_label("quarter_start_date", spec.grain).alias("quarter_label"),
        "quarter_start_date",
        period_end("quarter_start_date", spec.grain).alias("quarter_end_date"),
        (F.col("pos") + 1).cast("long").alias("quarter_index"))


def user_period_activity(events: DataFrame, identity: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Exactly one row per (person, analysis period), active or not.

    Persons come from the identity map (unambiguous, non-NULL), periods from the
    parameters. The dense rows are never shuffled:

    1. in-scope events are aggregated per (person, period index) -- the sparse
       activity, combined in the map tasks, so a person holding a large share of
       the events reaches the shuffle as at most one partial row per period;
    2. persons and their sparse periods meet in ONE aggregate keyed by person
       (at most one entry per period per person, a bound set by the parameters);
    3. each person row is expanded in place to every period, inactive ones
       included (a Generate after the shuffle).

    The result is hash-partitioned by person, so windows and aggregates keyed by
    person downstream (transitions, cohorts, ...) need no further shuffle, and a
    bucketed write by person has one writer per bucket. No join, no cross join,
    no distinct.
    """
    return dense_fact(sparse_activity(events, spec), identity, spec)


def sparse_activity(events: DataFrame, spec: ChurnSpec = DEFAULT_SPEC, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (``by``, person, period index) with in-scope events. Rows of the same person and period
    are partial states: :func:`merge_sparse` adds them up."""
    first = periods_of(spec.period_start, spec.period_end, spec.grain)[0].start
    ev = (events.filter(F.col("is_in_scope"))
          .select(*by, "unified_user_id",
                  period_index("activity_date", first, spec.grain).alias("quarter_index"),
                  *[c for c in ("channel",) if c not in by], "source_feed", "event_or_status", "amount_sar", "activity_date",
                  *[activity_col(d) for d in spec.definitions]))
    ch, st = F.col("channel"), F.col("event_or_status")
    counts_p = F.col(activity_col(spec.primary))
    is_coupon, is_cash = ch == COUPON, ch == CASHBACK
    dec0 = F.lit(0).cast("decimal(38,9)")
    metrics = {
        "eligible_coupon_events": F.count_if(is_coupon & counts_p),
        "cashback_transactions_total": F.count_if(is_cash),
        "cashback_approved_transactions": F.count_if(is_cash & (st == APPROVED)),
        "cashback_pending_transactions": F.count_if(is_cash & (st == PENDING)),
        "cashback_excluded_transactions": F.count_if(is_cash & st.isin(*EXCLUDED_STATUSES)),
        "affiliate_sources": F.array_sort(F.collect_set(F.when(is_cash & counts_p, F.col("source_feed")))),
        "approved_amount_sar": F.sum(F.when(is_cash & (st == APPROVED), F.col("amount_sar")).otherwise(dec0)),
        "pending_amount_sar": F.sum(F.when(is_cash & (st == PENDING), F.col("amount_sar")).otherwise(dec0)),
        **{active_col(d): F.bool_or(activity_col(d)) for d in spec.definitions},
        "is_active_coupon": F.bool_or(is_coupon & counts_p),
        "is_active_cashback": F.bool_or(is_cash & counts_p),
        "first_activity_date": F.min(F.when(counts_p, F.col("activity_date"))),
        "last_activity_date": F.max(F.when(counts_p, F.col("activity_date"))),
    }
    return ev.groupBy(*by, "unified_user_id", "quarter_index").agg(*[c.alias(n) for n, c in metrics.items()])


def merge_sparse(partial: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Partial rows of :func:`sparse_activity` as one row per (person, period index)."""
    kinds = dict(partial.dtypes)

    def merged(name: str):
        if name == "affiliate_sources":     # bounded: the networks of one person and period
            return F.array_sort(F.array_distinct(F.flatten(F.collect_list(name))))
        if kinds[name] == "boolean":
            return F.bool_or(name)
        if kinds[name] == "date":
            return F.min(name) if name.startswith("first") else F.max(name)
        return F.sum(name).cast(kinds[name])
    keys = ["unified_user_id", "quarter_index"]
    out = [c for c in partial.columns if c in SPARSE_METRICS or c.startswith("is_active_")]
    return partial.groupBy(*keys).agg(*[merged(c).alias(c) for c in out])


SPARSE_METRICS = ("eligible_coupon_events", "cashback_transactions_total", "cashback_approved_transactions",
                  "cashback_pending_transactions", "cashback_excluded_transactions", "affiliate_sources",
                  "approved_amount_sar", "pending_amount_sar", "first_activity_date", "last_activity_date")


def dense_fact(sparse: DataFrame, identity: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """The persons of the identity map at every period, from the sparse rows (one per person and period)."""
    periods = periods_of(spec.period_start, spec.period_end, spec.grain)
    prim, strict = spec.primary, spec.strict
    dec0 = F.lit(0).cast("decimal(38,9)")
    metrics = [c for c in sparse.columns if c not in ("unified_user_id", "quarter_index")]
    packed = sparse.select("unified_user_id", F.lit(False).alias("_person"),
                           F.struct("quarter_index", *metrics).alias("_m"))
    persons = (identity.filter(~F.col("has_ambiguous_mapping") & F.col("unified_user_id").isNotNull())
               .select("unified_user_id", F.lit(True).alias("_person"),
                       F.lit(None).cast(packed.schema["_m"].dataType).alias("_m")))
    per_person = (persons.unionByName(packed).groupBy("unified_user_id")
                  .agg(F.bool_or("_person").alias("_in_spine"), F.collect_list("_m").alias("_ms"))
                  .filter("_in_spine"))
    # the row of every period, found in the person's few sparse ones, then one row each: the Generate
    # copies one row of metrics a period and not the person's whole map
    def row(i):
        return F.struct(i.alias("quarter_index"), F.get(F.filter("_ms", lambda m: m["quarter_index"] == i), 0).alias("_r"))

    every = F.array(*[F.lit(p.index).cast("long") for p in periods])
    dense = per_person.select("unified_user_id", F.inline(F.transform(every, row)))
    r = F.col("_r")
    got = lambda n, default: F.coalesce(r[n], default)
    f0 = F.lit(False)
    cpn, csh = got("is_active_coupon", f0), got("is_active_cashback", f0)
    at = lambda vals: F.element_at(F.array(*[F.lit(v) for v in vals]), F.col("quarter_index").cast("int"))
    return dense.select(
        "unified_user_id", at([p.label for p in periods]).alias("quarter_label"),
        at([p.start for p in periods]).alias("quarter_start_date"),
        at([p.end for p in periods]).alias("quarter_end_date"), "quarter_index",
        *[got(n, F.lit(0).cast("long")).alias(n) for n in
          ["eligible_coupon_events", "cashback_transactions_total", "cashback_approved_transactions",
           "cashback_pending_transactions", "cashback_excluded_transactions"]],
        F.when(r.isNull(), 0).otherwise(F.size(r["affiliate_sources"])).cast("long").alias("distinct_affiliate_sources"),
        got("approved_amount_sar", dec0).alias("approved_amount_sar"),
        got("pending_amount_sar", dec0).alias("pending_amount_sar"),
        *[got(active_col(d), f0).alias(active_col(d)) for d in spec.definitions],
        cpn.alias("is_active_coupon"), csh.alias("is_active_cashback"),
        F.when(cpn & csh, "both").when(cpn, "coupon_only").when(csh, "cashback_only")
        .otherwise("inactive").alias("activity_mix"),
        (got(active_col(prim), f0) & ~got(active_col(strict), f0)).alias("is_active_on_pending_only"),
        r["first_activity_date"].alias("first_activity_date"), r["last_activity_date"].alias("last_activity_date"),
    )


def by_definition(fact: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per definition x person x period (a Generate, no shuffle)."""
    arr = F.array(*[F.struct(F.lit(d.name).alias("definition_name"), F.col(active_col(d)).alias("is_active"))
                    for d in spec.definitions])
    return fact.select(
        F.inline(arr), "unified_user_id", "quarter_label", "quarter_start_date", "quarter_index",
        "activity_mix", "is_active_on_pending_only",
    ).select("definition_name", "unified_user_id", "quarter_label", "quarter_start_date", "quarter_index",
             "is_active", "activity_mix", "is_active_on_pending_only")
