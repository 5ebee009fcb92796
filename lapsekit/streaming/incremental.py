"""Incremental staging on activity month, driven by Structured Streaming.

New raw rows of a feed arrive as files in a landing folder. Each micro-batch
(``foreachBatch``) is written to a raw table partitioned by ``_batch`` (the stream's
id and the epoch: two streams into one store never meet in a folder) and
``activity_month``. A batch written again after a retry replaces exactly its own
folders, so a replayed epoch is not double counted. Then only the months that the
batch touches are re-staged:

* touched keys  = the business keys in the batch (a late status update of an
  old transaction is a new raw row with an old key); rows without a key are
  never merged with others and so touch only their own month,
* affected months = the batch's own months plus every month in which a raw row of a
  touched key lives (a semi-join of the raw rows with the touched keys). With
  ``reprocess_months`` -- the longest time a decision takes -- only raw months from that
  long before the batch's first month on are searched, so that a batch costs as much as
  the window and not as the history; without it all are,
* re-stage = the staging operator over the affected months' raw rows of touched
  keys and of no key (only those folders are read); staged rows of other keys stay as they
  are, for their copies may lie in other months.

All writes of a batch are one transaction of a :class:`~lapsekit.sources.versions.VersionedStore`:
they go to new folders, and one manifest makes them visible together. A driver that is lost at any
moment leaves the state before the batch, and the retry starts from there.

All copies of a touched key are inside the affected months (with a window: of keys
whose copies are no further apart), so the result equals a full rebuild.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsekit.functions.text import norm_key
from lapsekit.sources.feeds import CASHBACK_SCHEMA, COUPON_SCHEMA
from lapsekit.sources.versions import Snapshot, Transaction, VersionedStore, partition_values
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC

FEEDS = {
    # feed: (raw schema, business key, activity date column)
    "cashback": (CASHBACK_SCHEMA, "transaction_id", "purchase_date"),
    "coupon": (COUPON_SCHEMA, "coupon_event_id", "event_date"),
}
MONTH = "activity_month"
BATCH = "_batch"
COMPACTED = "compacted"
IDENTITY, EVENTS = "stg_identity_map", "int_unified_activity_events"


class IncrementalStaging:
    def __init__(self, spark: SparkSession, root: str, feed: str = "cashback", spec: ChurnSpec = DEFAULT_SPEC,
                 reprocess_months: int | None = None, store: VersionedStore | None = None):
        self.spark, self.feed, self.spec = spark, feed, spec
        self.schema, self.key, self.date = FEEDS[feed]
        self.store = store or VersionedStore(spark, root)
        self.raw_table, self.stg_table = f"raw_{feed}", f"stg_{feed}"
        self.reprocess_months = reprocess_months
        month = T.StructField(MONTH, T.DateType())
        self.raw_schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.StringType()), month])
        self.stg_schema = T.StructType([*self._stage(spark.createDataFrame([], self.schema)).schema.fields, month])

    def _stage(self, raw: DataFrame) -> DataFrame:
        from lapsekit.operators.staging import stage_cashback, stage_coupons
        return (stage_cashback if self.feed == "cashback" else stage_coupons)(raw, self.spec)

    def raw(self, snapshot: Snapshot | None = None, where=None) -> DataFrame:
        return self.store.read(self.raw_table, self.raw_schema, (BATCH, MONTH), snapshot, where)

    def staged(self, snapshot: Snapshot | None = None, months: list | None = None) -> DataFrame:
        where = None if months is None else of_months(months)
        return self.store.read(self.stg_table, self.stg_schema, (MONTH,), snapshot, where).drop(MONTH)

    def _key(self):
        return norm_key(F.col(self.key))

    def _months_with(self, tx: Transaction, keys: DataFrame, others) -> set:
        """Months of the raw rows of other batches (``others``: the partitions searched) that have one of the keys."""
        raw = self.raw(tx.snapshot, others)
        touched = raw.filter(F.col(self.key).isNotNull()).select(MONTH, self._key().alias("_k")).join(keys, "_k", "left_semi")
        return {r[0] for r in touched.select(MONTH).distinct().collect()}      # bounded by the calendar

    def apply(self, batch: DataFrame, epoch_id: int, stream: str = "direct", tx: Transaction | None = None) -> list:
        """Land one batch and re-stage the months it touches; returns those months. A batch is
        known by (``stream``, ``epoch_id``): the same pair again replaces the earlier rows. Rows landed
        and staged become visible together; with ``tx``, when that transaction commits."""
        if tx is None:
            with self.store.transaction() as tx:
                return self.apply(batch, epoch_id, stream, tx)
        cols, name = self.schema.fieldNames(), f"{stream}-{int(epoch_id)}"
        same = lambda p: p[BATCH] == name
        before = {month_of(partition_values(p)) for p in tx.snapshot.partitions(self.raw_table, same)}
        keys = batch.select(self._key().alias("_k"))
        if before:                              # of the same batch before a retry: its rows go
            keys = keys.union(self.raw(tx.snapshot, same).select(self._key()))
        keys = keys.filter("_k IS NOT NULL").distinct()
        b = batch.select(*cols).withColumn(BATCH, F.lit(name)).withColumn(MONTH, F.trunc(F.col(self.date), "month"))
        if before:
            keys = tx.scratch(keys)             # read before the batch is written again
        written = tx.write(b.hint("rebalance", MONTH), self.raw_table, (BATCH, MONTH), same)
        own = before | {month_of(partition_values(p)) for p in written}
        since = None                            # the window reaches back from the batch's first month
        if self.reprocess_months is not None and (dated := [m for m in own if m is not None]):
            since = months_before(min(dated), self.reprocess_months)
        in_window = lambda p: since is None or month_of(p) is None or month_of(p) >= since
        others = lambda p: not same(p) and in_window(p)
        months = own
        if tx.snapshot.partitions(self.raw_table, others):      # the batch's own rows need no search: all are touched
            keys = keys if before else tx.scratch(keys)
            months = own | self._months_with(tx, keys, others)
        months = sorted(months, key=lambda m: (m is not None, m))
        if not months:
            return []
        rows, inside = self.raw(tx.snapshot, same).select(*cols), of_months(months)
        mixed = lambda p: not same(p) and inside(p)
        if tx.snapshot.partitions(self.raw_table, mixed):       # rows of other batches: of touched keys, and those of no key
            raw = self.raw(tx.snapshot, mixed).withColumn("_k", self._key())
            rows = rows.unionByName(raw.join(keys, "_k", "left_semi").unionByName(raw.filter("_k IS NULL")).select(*cols))
        staged = self._stage(rows)
        if tx.snapshot.partitions(self.stg_table, inside):      # rows of other keys stay as they are
            kept = self.staged(tx.snapshot, months).filter(F.col(self.key).isNotNull())
            staged = staged.unionByName(kept.join(keys, kept[self.key] == keys["_k"], "left_anti"))
        staged = staged.withColumn(MONTH, F.trunc(F.col(self.date), "month"))
        tx.write(staged.hint("rebalance", MONTH).sortWithinPartitions(MONTH, self.key), self.stg_table, (MONTH,), of_months(months))
        return months

    def compact_raw(self) -> None:
        """Merge the raw rows of all batches but the newest of each stream (the only one that a stream can send
        again) into one batch, so that the number of folders follows the calendar and not the batches."""
        with self.store.transaction() as tx:
            newest: dict[str, int] = {}
            names = {partition_values(p)[BATCH] for p in tx.snapshot.partitions(self.raw_table)}
            for stream, epoch in (n.rsplit("-", 1) for n in names if n != COMPACTED):
                newest[stream] = max(int(epoch), newest.get(stream, 0))
            old = names - {f"{s}-{e}" for s, e in newest.items()}
            if len(old) > 1:
                rows = self.raw(tx.snapshot, lambda p: p[BATCH] in old).withColumn(BATCH, F.lit(COMPACTED))
                tx.write(rows.hint("rebalance", MONTH), self.raw_table, (BATCH, MONTH), lambda p: p[BATCH] in old)

    def full_rebuild(self) -> DataFrame:
        return self._stage(self.raw().select(*self.schema.fieldNames()))


def month_of(partition: dict) -> dt.date | None:
    value = partition[MONTH]
    return None if value is None else dt.date.fromisoformat(value)


def of_months(months):
    """Whether a partition is that of one of the months (None: of rows without a date)."""
    known = set(months)
    return lambda p: month_of(p) in known


def months_before(month: dt.date, n: int) -> dt.date:
    at = month.year * 12 + month.month - 1 - n
    return dt.date(at // 12, at % 12 + 1, 1)


class IncrementalEvents:
    """The unified event stream kept incrementally: both feeds are staged by
    :class:`IncrementalStaging`, the events are stored partitioned by (channel,
    month), and after each batch only the batch's channel and months are rebuilt
    (identity resolution of those months' staged rows). Raw, staged and event rows of a batch, and
    the marts of an :class:`~lapsekit.streaming.marts.IncrementalMarts`, become visible in one commit.
    The identity map is an input of the build: the store remembers it, and opening the store with
    another map is refused until all events have been resolved anew (``accept_new_identity``)."""

    def __init__(self, spark: SparkSession, root: str, identity_raw: DataFrame, spec: ChurnSpec = DEFAULT_SPEC,
                 reprocess_months: int | None = None, accept_new_identity: bool = False, marts: bool = False):
        from lapsekit.operators.staging import stage_identity
        self.spark, self.spec = spark, spec
        self.store = VersionedStore(spark, root)
        self.coupons = IncrementalStaging(spark, root, "coupon", spec, reprocess_months, self.store)
        self.cashback = IncrementalStaging(spark, root, "cashback", spec, reprocess_months, self.store)
        staged = stage_identity(identity_raw, spec)
        self.events_schema = self._resolve("coupon", self.coupons.staged(Snapshot()), self.spark.createDataFrame([], staged.schema)).schema
        self.marts = None
        if marts:
            from lapsekit.streaming.marts import IncrementalMarts
            self.marts = IncrementalMarts(self)
        with self.store.transaction() as tx:
            known = tx.snapshot.partitions(IDENTITY)
            stored = self.store.read(IDENTITY, staged.schema, (), tx.snapshot)
            if known and fingerprint(stored) == fingerprint(staged):
                self.identity = stored
                return
            if known and not accept_new_identity:
                raise ValueError("the identity map differs from the one the stored events were resolved with; "
                                 "open the store with accept_new_identity=True to resolve them anew")
            # staged once and stored: every batch resolves its months against the same map
            tx.write(staged.sortWithinPartitions("source_system", "source_user_id"), IDENTITY, (), lambda p: True)
            self.identity = self.store.read(IDENTITY, staged.schema, (), tx.snapshot)
            if known:
                self._rebuild(tx)
            if self.marts is not None:
                self.marts.rebuild(tx)

    def _resolve(self, feed: str, staged: DataFrame, identity: DataFrame | None = None) -> DataFrame:
        from lapsekit.operators.events import resolve_events, with_period_columns
        parts = {"coupon": self.coupons.staged(Snapshot()), "cashback": self.cashback.staged(Snapshot()), feed: staged}
        identity = self.identity if identity is None else identity
        ev = resolve_events(parts["coupon"], parts["cashback"], identity, self.spec).withColumn(MONTH, F.trunc("activity_date", "month"))
        # columns that follow from others of the row are made after the shuffle to the month folders
        return with_period_columns(ev.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "unified_user_id"), self.spec)

    def apply(self, feed: str, batch: DataFrame, epoch_id: int, stream: str = "direct") -> list:
        """Stage the batch, then rebuild only this feed's event partitions
        (channel, month) for the months it touched; the other channel's events
        are not read or rewritten."""
        inc = self.coupons if feed == "coupon" else self.cashback
        with self.store.transaction() as tx:
            months = inc.apply(batch, epoch_id, stream, tx)
            if months:
                self._write_events(tx, feed, inc.staged(tx.snapshot, months), of_months(months))
                if self.marts is not None:
                    self.marts.update(tx, feed, months)
        return months

    def _write_events(self, tx: Transaction, feed: str, staged: DataFrame, months) -> None:
        tx.write(self._resolve(feed, staged), EVENTS, ("channel", MONTH), lambda p: p["channel"] == feed and months(p))

    def _rebuild(self, tx: Transaction) -> None:
        """Resolve all staged events anew (after a change of the identity map)."""
        for feed, inc in (("coupon", self.coupons), ("cashback", self.cashback)):
            self._write_events(tx, feed, inc.staged(tx.snapshot), lambda p: True)

    def events_of(self, snapshot: Snapshot | None = None, where=None) -> DataFrame:
        return self.store.read(EVENTS, self.events_schema, ("channel", MONTH), snapshot, where).drop(MONTH)

    def events(self) -> DataFrame:
        return self.events_of()

    def full_rebuild(self) -> DataFrame:
        from lapsekit.operators.events import unify_events
        return unify_events(self.coupons.full_rebuild(), self.cashback.full_rebuild(), self.identity, self.spec)


def fingerprint(df: DataFrame) -> tuple:
    """Row count and a sum of row hashes: equal for equal tables in any order."""
    row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    return tuple(df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first())


def stream_id(checkpoint: str) -> str:
    """A stream is known by its checkpoint: a restart keeps the id, another checkpoint gets another."""
    return "s" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def start_incremental_stream(spark: SparkSession, landing: str, root: str, checkpoint: str,
                             feed: str = "cashback", fmt: str = "csv", spec: ChurnSpec = DEFAULT_SPEC,
                             available_now: bool = True, model: IncrementalEvents | None = None,
                             max_files: int | None = None, reprocess_months: int | None = None):
    """Run the incremental build as a streaming query over a landing folder of one
    feed. Without ``model`` each micro-batch re-stages the feed's touched months;
    with an :class:`IncrementalEvents` model it also rebuilds the feed's touched
    event months. ``checkpoint`` must be a shared folder (the stream's offsets);
    ``max_files`` bounds the files of a micro-batch."""
    inc = model.coupons if (model is not None and feed == "coupon") else \
        model.cashback if model is not None else IncrementalStaging(spark, root, feed, spec, reprocess_months)
    reader = spark.readStream.schema(inc.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream, name = reader.format(fmt).load(landing), stream_id(checkpoint)

    def sink(df: DataFrame, epoch: int) -> None:
        if model is None:
            inc.apply(df, epoch, name)
        else:
            model.apply(feed, df, epoch, name)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return inc, w.start()
