"""Materialisation (S5) and export.

Intermediate layers are written as Parquet under the folder the session names in
``spark.checkpoint.dir`` (a shared, cluster-visible location). A cluster session that
names none gets an error; local sessions (tests) get a temporary folder.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "activity_month"
# bytes that a task of a stored build takes in, at most: staging rows need 7 times as much when they are sorted
# and event rows, which repeat much, 12 times
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
# ids of rows and users, of which a file holds nearly as many as rows: no Parquet dictionary is tried for them
# (the files are no larger and are written faster; minima and maxima of row groups stay)
ID_COLUMNS = ("coupon_event_id", "coupon_user_id", "transaction_id", "cashback_user_id", "source_event_id", "source_user_id",
              "unified_user_id")
_BOUNDED: "weakref.WeakKeyDictionary[SparkSession, list]" = weakref.WeakKeyDictionary()
_BOUNDED_LOCK = threading.Lock()


def _bytes(size: str) -> int:
    n, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(n) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def bounded_tasks(spark: SparkSession):
    """Within it, tasks of this session's queries take in no more than ``TASK_BYTES`` (smaller settings of the
    session stay), so that what a task sorts fits its memory however large the input; the settings
    are put back when the last of several threads leaves."""
    with _BOUNDED_LOCK:
        state = _BOUNDED.setdefault(spark, [0, {}])
        if not state[0]:
            for key, most in TASK_BYTES.items():
                state[1][key] = spark.conf.get(key, None)
                if _bytes(state[1][key] or spark.conf.get(key)) > most:
                    spark.conf.set(key, str(most))
        state[0] += 1
    try:
        yield
    finally:
        with _BOUNDED_LOCK:
            state[0] -= 1
            if not state[0]:
                for key, was in state[1].items():
                    spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def scratch_dir(spark: SparkSession) -> str:
    """The shared scratch root of this session (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        check_local(sc.master)
        d = tempfile.mkdtemp(prefix="lapsekit-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def check_local(master: str) -> None:
    """A machine-local folder only serves a driver whose executors run inside it."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def in_month_range(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The rows of the month folders from ``first`` to ``last``, without the month column: a partition
    filter for stored tables, nothing for tables that have no such column."""
    if MONTH not in df.columns:
        return df
    return df.filter(F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last))).drop(MONTH)


def new_location(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_dir(spark), "lapsekit", f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, path: str, *, partition_month: str | None = None,
                cluster: list[str] | None = None, mode: str = "overwrite",
                dynamic: bool = False, max_records_per_file: int = 5_000_000,
                bucket_by: tuple[int, str] | None = None, keep_month: bool = False,
                derive: Callable[[DataFrame], DataFrame] | None = None, from_months: bool = False) -> DataFrame:
    """Write a model as Parquet and return a DataFrame reading it back.

    ``partition_month``: a DATE column; rows are written into ``activity_month``
    folders; ``keep_month`` keeps that column, and a filter on it (``in_month_range``)
    then reads only the folders it needs. ``cluster``: columns to
    sort within each output file so Parquet min/max statistics skip row groups on
    point lookups. ``dynamic``: only the months present in ``df`` are replaced
    (incremental rebuilds). ``bucket_by=(n, column)``: the table is written in
    ``n`` buckets by ``column`` (an external table at ``path``, registered in the
    session catalog), so later aggregates and windows keyed by that column read
    it already partitioned and need no shuffle. ``derive``: from the rows as shuffled to those as
    written (columns that follow from others of the row need not go through the shuffle).
    ``from_months``: ``df`` is read from folders of the same months, so a task's rows are of few months
    already and are not shuffled again.
    """
    spark = df.sparkSession
    with bounded_tasks(spark):
        return _materialise(spark, df, path, partition_month, cluster, mode, dynamic, max_records_per_file, bucket_by,
                            keep_month, derive or (lambda rows: rows), from_months)


def _materialise(spark, df, path, partition_month, cluster, mode, dynamic, max_records_per_file, bucket_by, keep_month,
                 derive, from_months) -> DataFrame:
    columns = derive(df).columns
    if bucket_by is not None:
        n, col = bucket_by
        name = "lapsekit_" + "".join(ch if ch.isalnum() else "_" for ch in os.path.basename(path)) + \
            "_" + uuid.uuid4().hex[:10]
        (derive(df).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
         .bucketBy(n, col).sortBy(*(cluster or [col])).option("path", path).saveAsTable(name))
        return spark.table(name).select(*columns)
    out = df
    if partition_month:
        out = out.withColumn("activity_month", F.trunc(F.col(partition_month), "month"))
        # REBALANCE on the month: AQE groups each month into few tasks (few files per
        # folder) and splits a month that holds a large share of the rows over several
        # tasks (no hot writer), without a sampling pass over the data
        if not from_months:
            out = out.hint("rebalance", "activity_month")
        out = out.sortWithinPartitions("activity_month", *(cluster or []))
    elif cluster:
        out = out.sortWithinPartitions(*cluster)
    out = derive(out)
    w = out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    for c in ID_COLUMNS:
        if c in out.columns:
            w = w.option(f"parquet.enable.dictionary#{c}", "false")
    if partition_month:
        w = w.partitionBy("activity_month")
    w.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)
    back = spark.read.schema(out.schema).parquet(path)     # schema given: an empty table reads back empty
    return back.select(*columns, *([MONTH] if partition_month and keep_month else []))


def drop_build(spark: SparkSession, location: str) -> None:
    """Remove a stored build: its catalog entries (bucketed tables) and its files."""
    root = location.rstrip("/")
    for t in spark.catalog.listTables():
        if t.name.startswith("lapsekit_"):
            at = spark.sql(f"DESCRIBE FORMATTED {t.name}").filter("col_name = 'Location'").first()
            if at is not None and f"{at['data_type'].rstrip('/')}/".split(":", 1)[-1].lstrip("/").startswith(
                    f"{root}/".split(":", 1)[-1].lstrip("/")):
                spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def export_summary(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """The tidy summary as one CSV file with a header (the result is ~100 rows). Decimals are
    written in full (0.000000000, not 0E-9), so that any reader takes them as numbers."""
    plain = {c: F.col(c).cast("string") for c, kind in df.dtypes if kind.startswith("decimal")}
    order = order or ["section_order", "definition_name", "period", "metric"]
    df.orderBy(*order).withColumns(plain).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
