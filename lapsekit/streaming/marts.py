"""Fact, active base, transitions and cohort kept incrementally on top of the event stream (E11 above M05).

Change propagation, in the transaction of the batch:

1. ``partial_activity`` holds mergeable partial states, one row per (channel, month, person,
   period). Only the batch's channel and months are computed anew; rows that differ from
   the stored ones name the touched (person, period) pairs.
2. ``person_activity`` holds one row per (person, period) with activity, partitioned by a hash
   bucket of the person. The touched pairs are merged from the partial states of their periods' months;
   only buckets with a touched person are read and written.
3. The counts of the marts are sums over persons. A touched person's contribution before the
   batch is taken back and the one after it added: both come from the same operators as
   the full build, run over the touched persons' dense rows only. Rates are formed on reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsekit.functions.periods import periods_of
from lapsekit.functions.rates import rate
from lapsekit.operators.cohort import cohort_summary, cohort_users
from lapsekit.operators.fact import by_definition, dense_fact, merge_sparse, sparse_activity
from lapsekit.operators.marts import active_base, transitions
from lapsekit.sources.versions import Snapshot, Transaction

PARTIAL, PERSON, BUCKET = "partial_activity", "person_activity", "_bucket"
KEYS = {"active_base": ("definition_name", "quarter_label", "quarter_index"),
        "transitions": ("definition_name", "from_quarter", "to_quarter"),
        "cohort_summary": ("definition_name",)}


class IncrementalMarts:
    """``model`` is the :class:`~lapsekit.streaming.incremental.IncrementalEvents` whose batches it follows.
    ``buckets``: folders of person rows; a batch rewrites those of its touched persons."""

    def __init__(self, model, buckets: int = 64):
        from lapsekit.streaming.incremental import MONTH
        self.model, self.store, self.spec, self.buckets, self.month = model, model.store, model.spec, buckets, MONTH
        empty = model.events_of(Snapshot())
        partial = sparse_activity(empty.withColumn(MONTH, F.trunc("activity_date", "month")), self.spec, ("channel", MONTH))
        self.partial_schema = partial.schema
        person = merge_sparse(partial, self.spec).withColumn(BUCKET, F.lit(0))
        self._schemas: dict[str, T.StructType] = {}
        self.person_schema = T.StructType([T.StructField(f.name, f.dataType) for f in person.schema.fields])

    # ---- reading ---------------------------------------------------------------------------
    def sparse(self, snapshot: Snapshot | None = None, buckets: set | None = None) -> DataFrame:
        where = None if buckets is None else (lambda p: int(p[BUCKET]) in buckets)
        return self.store.read(PERSON, self.person_schema, (BUCKET,), snapshot, where).drop(BUCKET)

    def fact(self) -> DataFrame:
        """M06 from the person rows: nothing is read of the events."""
        return dense_fact(self.sparse(), self.model.identity, self.spec)

    def _counts(self, name: str, snapshot: Snapshot | None = None) -> DataFrame:
        if name not in self._schemas:
            self._schemas[name] = self._of(name, dense_fact(self.sparse(Snapshot()), self._no_persons(), self.spec)).schema
        return self.store.read(f"counts_{name}", self._schemas[name], (), snapshot)

    def active_base(self) -> DataFrame:
        return self._counts("active_base")

    def transitions(self) -> DataFrame:
        c = self._counts("transitions")
        return c.select(
            "definition_name", "from_quarter", "to_quarter", "active_base", "retained_users", "churned_users",
            rate("churned_users", "active_base").alias("next_quarter_churn_rate"),
            rate("retained_users", "active_base").alias("next_quarter_retention_rate"), "new_or_returning_users")

    def cohort_summary(self) -> DataFrame:
        """M13 with its rates, formed from the kept counts."""
        from lapsekit.operators.cohort import cohort_rates
        return cohort_rates(self._counts("cohort_summary"), self.spec)

    # ---- writing ---------------------------------------------------------------------------
    def _no_persons(self) -> DataFrame:
        return self.store.spark.createDataFrame([], "unified_user_id string, has_ambiguous_mapping boolean")

    def _of(self, name: str, fact: DataFrame) -> DataFrame:
        """The counts of a mart over the given persons' dense rows, without rates."""
        long = by_definition(fact, self.spec)
        out = (active_base(long) if name == "active_base" else transitions(long, self.spec) if name == "transitions"
               else cohort_summary(cohort_users(long, self.spec), self.spec))
        return out.select(*KEYS[name], *[F.col(c).cast("long").alias(c) for c, kind in out.dtypes
                                         if kind in ("bigint", "int") and c not in KEYS[name]])

    def _bucket(self):
        return F.pmod(F.xxhash64("unified_user_id"), F.lit(self.buckets)).cast("int")

    def _months_of(self, index: int) -> list[dt.date]:
        """The calendar months that a period reaches into."""
        p = periods_of(self.spec.period_start, self.spec.period_end, self.spec.grain)[index - 1]
        out, m = [], p.start.replace(day=1)
        while m <= p.end:
            out.append(m)
            m = (m + dt.timedelta(days=32)).replace(day=1)
        return out

    def _partial(self, snapshot: Snapshot, where) -> DataFrame:
        return self.store.read(PARTIAL, self.partial_schema, ("channel", self.month), snapshot, where)

    def rebuild(self, tx: Transaction) -> None:
        """All states from the stored events (at the start, and after a change of the identity map)."""
        month = F.trunc("activity_date", "month")
        partial = sparse_activity(self.model.events_of(tx.snapshot).withColumn(self.month, month), self.spec, ("channel", self.month))
        tx.write(partial.hint("rebalance", "channel", self.month), PARTIAL, ("channel", self.month), lambda p: True)
        person = merge_sparse(self._partial(tx.snapshot, None), self.spec)
        tx.write(person.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET), PERSON, (BUCKET,), lambda p: True)
        fact = dense_fact(self.sparse(tx.snapshot), self.model.identity, self.spec)
        for name in KEYS:
            tx.write(self._of(name, fact), f"counts_{name}", (), lambda p: True)

    def update(self, tx: Transaction, feed: str, months: list) -> list[int]:
        """Carry a batch's rewritten event months on; returns the touched periods."""
        from lapsekit.streaming.incremental import of_months
        inside = of_months(months)
        mine = lambda p: p["channel"] == feed and inside(p)
        old = self._partial(tx.before, mine)
        events = self.model.events_of(tx.snapshot, mine).withColumn(self.month, F.trunc("activity_date", "month"))
        tx.write(sparse_activity(events, self.spec, ("channel", self.month)).hint("rebalance", "channel", self.month),
                 PARTIAL, ("channel", self.month), mine)
        new = self._partial(tx.snapshot, mine)
        both = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
        changed = both.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
        touched = tx.scratch(changed.select("unified_user_id", "quarter_index", self._bucket().alias(BUCKET)).distinct())
        where = touched.agg(F.collect_set("quarter_index").alias("q"), F.collect_set(BUCKET).alias("b")).first()
        periods, buckets = sorted(where["q"]), set(where["b"])                # bounded by the parameters
        if not periods:
            return []
        reach = of_months({m for i in periods for m in self._months_of(i)})
        pairs, people = touched.drop(BUCKET), touched.select("unified_user_id").distinct()
        fresh = merge_sparse(self._partial(tx.snapshot, reach).join(pairs, ["unified_user_id", "quarter_index"], "left_semi"), self.spec)
        stored = self.sparse(tx.before, buckets)
        kept = stored.join(pairs, ["unified_user_id", "quarter_index"], "left_anti")
        now = kept.unionByName(fresh).withColumn(BUCKET, self._bucket())
        tx.write(now.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "unified_user_id"), PERSON, (BUCKET,),
                 lambda p: int(p[BUCKET]) in buckets)
        spine = self.model.identity.join(people, "unified_user_id", "left_semi")
        facts = {sign: tx.scratch(dense_fact(self.sparse(s, buckets).join(people, "unified_user_id", "left_semi"), spine, self.spec))
                 for sign, s in ((-1, tx.before), (1, tx.snapshot))}
        for name, keys in KEYS.items():
            rows = self._counts(name, tx.before)
            for sign, fact in facts.items():
                delta = self._of(name, fact)
                rows = rows.unionByName(delta.select(*keys, *[(F.col(c) * sign).alias(c) for c in delta.columns if c not in keys]))
            counts = [c for c in rows.columns if c not in keys]
            tx.write(rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]), f"counts_{name}", (), lambda p: True)
        return periods
