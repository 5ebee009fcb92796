"""Lazy, memoised access to every layer of the model.

``Layers(raw, spec)`` exposes stg / int / fct / marts as properties. Each is a
lazy DataFrame built from its parents; nothing runs until an action. When
``materialise=True`` the staging, event and fact layers are written once as
Parquet under the session's checkpoint folder and read back, which cuts the
lineage the ~20 downstream readers would otherwise recompute (and survives the
loss of an executor: a re-run task reads files, not recomputed shuffles).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lapsekit.sources.adapter import RawInputs
from lapsekit.spec import CASHBACK, COUPON, ChurnSpec, DEFAULT_SPEC


class Layers:
    def __init__(self, raw: RawInputs, spec: ChurnSpec = DEFAULT_SPEC, *, materialise: bool = False,
                 location: str | None = None, buckets: int | None = None):
        self.raw = raw
        self.spec = spec
        self.materialise = materialise
        self.buckets = buckets        # person buckets of the stored fact (default: shuffle partitions)
        self._location = location
        import threading
        self._lock = threading.Lock()
        self._stored: dict[str, DataFrame] = {}
        self._name_locks: dict[str, threading.Lock] = {}

    def build(self, parallel: bool = True) -> "Layers":
        """Write the stored layers now (when ``materialise``). The three staging
        tables do not depend on each other, so they are submitted as concurrent
        Spark jobs from separate threads (the scheduler interleaves their tasks);
        events, fact and the check results follow in dependency order."""
        if not self.materialise:
            return self
        if self._location is None:
            from lapsekit.sources.sinks import new_location
            self._location = new_location(self.spark, "build")
        first = ["stg_identity", "stg_coupons", "stg_cashback"]
        if parallel:
            self._together(*first)
        else:
            for n in first:
                getattr(self, n)
        for n in ("events", "fact", "dq_check_results"):
            getattr(self, n)
        return self

    def _together(self, *names: str) -> None:
        """Layers that do not depend on each other, stored by concurrent jobs: one's tasks fill the cores that
        the last tasks of the other's stages leave idle."""
        if self.materialise:
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=len(names)) as pool:
                for f in [pool.submit(getattr, self, n) for n in names]:
                    f.result()

    @property
    def spark(self) -> SparkSession:
        return self.raw.identity.sparkSession

    def _store(self, name: str, df: DataFrame, partition_month: str | None = None,
               cluster: list[str] | None = None, bucket_col: str | None = None, keep_month: bool = False,
               derive=None, from_months: bool = False) -> DataFrame:
        if not self.materialise:
            return df if derive is None else derive(df)
        import os
        import threading
        from lapsekit.sources.sinks import new_location
        with self._lock:                       # one writer per stored object, even across threads
            if self._location is None:
                self._location = new_location(self.spark, "build")
            loc = self._location
            name_lock = self._name_locks.setdefault(name, threading.Lock())
        with name_lock:
            if name in self._stored:
                return self._stored[name]
            self._stored[name] = self._write(df, os.path.join(loc, name), partition_month, cluster, bucket_col, keep_month, derive, from_months)
            return self._stored[name]

    def _write(self, df, path, partition_month, cluster, bucket_col, keep_month, derive, from_months):
        from lapsekit.sources.sinks import materialise
        bucket = (self.buckets or self._bucket_count(), bucket_col) if bucket_col else None
        return materialise(df, path, partition_month=partition_month, cluster=cluster, bucket_by=bucket,
                           keep_month=keep_month, derive=derive, from_months=from_months)

    def _bucket_count(self, rows_per_bucket: int = 2_000_000) -> int:
        """Buckets of the stored fact from its size, which is known before it is built: persons times
        periods. Small facts get no more buckets than there are cores to read them."""
        from lapsekit.functions.periods import periods_of
        n = len(periods_of(self.spec.period_start, self.spec.period_end, self.spec.grain))
        rows = n * self.stg_identity.count()
        cores = self.spark.sparkContext.defaultParallelism
        return max(1, -(-rows // rows_per_bucket), min(cores, -(-rows // 50_000)))

    def drop(self) -> None:
        """Remove what this build stored."""
        from lapsekit.sources.sinks import drop_build
        if self.materialise and self._location is not None:
            drop_build(self.spark, self._location)

    # ---- layer 1 ---------------------------------------------------------
    @cached_property
    def stg_identity(self) -> DataFrame:
        from lapsekit.operators.staging import stage_identity
        return self._store("stg_identity_map", stage_identity(self.raw.identity, self.spec),
                           cluster=["source_system", "source_user_id"])

    def _with_person(self, staged: DataFrame, system: str, user: str) -> DataFrame:
        """Stored feeds carry the person of each row: their rows are joined with the identity map before
        they go to their month folders, so neither join nor shuffle of the events follows. Lazy ones do not."""
        from lapsekit.operators.events import with_person
        return with_person(staged, self.stg_identity, system, user) if self.materialise else staged

    @cached_property
    def person_coupons(self) -> DataFrame:
        from lapsekit.operators.staging import stage_coupons
        staged = self._with_person(stage_coupons(self.raw.coupons, self.spec), COUPON, "coupon_user_id")
        return self._store("stg_coupon_events", staged, partition_month="event_date", cluster=["coupon_user_id"])

    @cached_property
    def person_cashback(self) -> DataFrame:
        from lapsekit.operators.staging import stage_cashback
        staged = self._with_person(stage_cashback(self.raw.cashback, self.spec), CASHBACK, "cashback_user_id")
        return self._store("stg_cashback_transactions", staged, partition_month="purchase_date",
                           cluster=["cashback_user_id", "source"])

    @cached_property
    def stg_coupons(self) -> DataFrame:
        from lapsekit.operators.events import PERSON
        return self.person_coupons.drop(*PERSON)

    @cached_property
    def stg_cashback(self) -> DataFrame:
        from lapsekit.operators.events import PERSON
        return self.person_cashback.drop(*PERSON)

    @cached_property
    def feed_sketches(self) -> DataFrame:
        from lapsekit.operators.sketches import feed_sketches
        return self._store("feed_sketches", feed_sketches(self.stg_cashback))

    # ---- layer 2 ---------------------------------------------------------
    @cached_property
    def events_by_month(self) -> DataFrame:
        """The events as stored, with the column of their month folders (lazy builds: without)."""
        from lapsekit.operators.events import resolve_events, with_period_columns
        self._together("person_coupons", "person_cashback")
        return self._store("int_unified_activity_events",
                           resolve_events(self.person_coupons, self.person_cashback, self.stg_identity, self.spec),
                           partition_month="activity_date", cluster=["unified_user_id", "channel"], keep_month=True,
                           from_months=True,
                           derive=lambda rows: with_period_columns(rows, self.spec))

    @cached_property
    def events(self) -> DataFrame:
        return self.events_by_month.drop("activity_month")

    @cached_property
    def period_events(self) -> DataFrame:
        """The events of the analysis range: of a stored build only these months' folders are read."""
        from lapsekit.sources.sinks import in_month_range
        return in_month_range(self.events_by_month, self.spec.period_start, self.spec.period_end)

    # ---- layer 3 ---------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        from lapsekit.operators.fact import user_period_activity
        # stored bucketed by person: every later window / aggregate keyed by person
        # (transitions, cohorts, hazard, rolling windows, grain check) reads it co-partitioned
        return self._store("fct_user_quarter_activity",
                           user_period_activity(self.period_events, self.stg_identity, self.spec),
                           cluster=["unified_user_id", "quarter_index"], bucket_col="unified_user_id")

    @cached_property
    def long(self) -> DataFrame:
        from lapsekit.operators.fact import by_definition
        return by_definition(self.fact, self.spec)

    @cached_property
    def spine(self) -> DataFrame:
        from lapsekit.operators.fact import period_spine
        return period_spine(self.spark, self.spec)

    # ---- layer 4/5 -------------------------------------------------------
    @cached_property
    def active_base(self) -> DataFrame:
        from lapsekit.operators.marts import active_base
        return active_base(self.long)

    @cached_property
    def transitions(self) -> DataFrame:
        from lapsekit.operators.marts import transitions
        return transitions(self.long, self.spec)

    @cached_property
    def sensitivity(self) -> DataFrame:
        from lapsekit.operators.marts import definition_sensitivity
        return definition_sensitivity(self.transitions, self.spec)

    @cached_property
    def disagreements(self) -> DataFrame:
        from lapsekit.operators.marts import definition_disagreements
        return definition_disagreements(self.fact)

    @cached_property
    def cohort_users(self) -> DataFrame:
        from lapsekit.operators.cohort import cohort_users
        return cohort_users(self.long, self.spec)

    @cached_property
    def cohort_summary(self) -> DataFrame:
        from lapsekit.operators.cohort import cohort_summary
        return cohort_summary(self.cohort_users, self.spec)

    # ---- layer 6/7 -------------------------------------------------------
    @cached_property
    def source_profile(self) -> DataFrame:
        from lapsekit.operators.profile import source_profile
        return source_profile(self.person_cashback, self.stg_identity, self.spec)

    @cached_property
    def cross_source_duplicates(self) -> DataFrame:
        from lapsekit.operators.profile import cross_source_duplicates
        return cross_source_duplicates(self.stg_cashback)

    @cached_property
    def cross_source_members(self) -> DataFrame:
        from lapsekit.operators.profile import cross_source_duplicate_members
        return cross_source_duplicate_members(self.stg_cashback)

    @cached_property
    def dq_check_results(self) -> DataFrame:
        """M16 with default tolerances, stored once when layers are materialised
        (the gate and the reports read the stored table)."""
        from lapsekit.operators.quality import dq_checks
        return self._store("dq_check_results", dq_checks(self, self.spec))

    def dq_checks(self, with_checked_at: bool = True, tolerance: dict | None = None) -> DataFrame:
        from lapsekit.operators.quality import dq_checks
        if tolerance is None and self.materialise:
            out = self.dq_check_results
            return out if with_checked_at else out.drop("checked_at")
        return dq_checks(self, self.spec, tolerance=tolerance, with_checked_at=with_checked_at)

    @cached_property
    def excluded_events(self) -> DataFrame:
        from lapsekit.operators.quality import excluded_events
        return excluded_events(self.events, self.spec)

    def publish_gate(self, raise_on_block: bool = False) -> DataFrame:
        from lapsekit.operators.quality import publish_gate
        return publish_gate(self.dq_checks(with_checked_at=False), raise_on_block)

    @cached_property
    def pending_exposure(self) -> DataFrame:
        from lapsekit.operators.pending import pending_exposure
        return pending_exposure(self.fact, self.events, self.spec)

    @cached_property
    def approval_maturity(self) -> DataFrame:
        from lapsekit.operators.pending import approval_maturity
        return approval_maturity(self.stg_cashback, self.spec)

    def activity_as_of(self, as_of) -> DataFrame:
        from lapsekit.operators.asof import activity_as_of
        from lapsekit.sources.sinks import in_month_range
        ev = in_month_range(self.events_by_month, self.spec.period_start, min(as_of, self.spec.period_end))
        return activity_as_of(ev, as_of, self.spec)

    @cached_property
    def transition_by_vintage(self) -> DataFrame:
        from lapsekit.operators.asof import transition_by_vintage
        return transition_by_vintage(self.period_events, self.spec)

    @cached_property
    def active_base_by_vintage(self) -> DataFrame:
        from lapsekit.operators.asof import active_base_by_vintage
        return active_base_by_vintage(self.period_events, self.spec)

    # ---- layer 8-10 ------------------------------------------------------
    def trace(self, user: str, step: int) -> DataFrame:
        from lapsekit.operators import trace as t
        if step == 1:
            return t.trace_identity(self.stg_identity, user)
        if step == 2:
            return t.trace_raw(self.raw.coupons, self.raw.cashback, self.stg_identity, user)
        if step == 3:
            return t.trace_events(self.events, user, self.spec)
        if step == 4:
            return t.trace_fact(self.fact, user, self.spec)
        if step == 5:
            return t.trace_cohort(self.cohort_users, user)
        return t.trace_contribution(self.long, user)

    @cached_property
    def report_summary(self) -> DataFrame:
        from lapsekit.operators.reporting import report_summary
        return report_summary(self.active_base, self.transitions, self.cohort_summary, self.pending_exposure,
                              self.spec)

    @cached_property
    def headline(self) -> DataFrame:
        from lapsekit.operators.reporting import headline
        return headline(self.transitions, self.pending_exposure, self.spec)

    @cached_property
    def cohort_funnel(self) -> DataFrame:
        from lapsekit.operators.reporting import cohort_funnel
        return cohort_funnel(self.cohort_summary, self.spec)

    @cached_property
    def maturity_curve(self) -> DataFrame:
        from lapsekit.operators.reporting import maturity_curve
        return maturity_curve(self.approval_maturity, self.spec)

    @cached_property
    def cardinality_ledger(self) -> DataFrame:
        from lapsekit.operators.monitoring import cardinality_ledger
        return cardinality_ledger(self)
