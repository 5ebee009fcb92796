"""Stored writes: tasks take in a bounded share of the input, and derived columns stay out of the shuffle."""

import os
import tempfile

from pyspark.sql import functions as F

from lapsekit.sources import sinks

ADVISORY, SPLIT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"


def test_settings_hold_within_and_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in (ADVISORY, SPLIT)}
    try:
        spark.conf.set(SPLIT, "1m")                                # smaller than the bound: stays
        with sinks.bounded_tasks(spark), sinks.bounded_tasks(spark):
            assert int(spark.conf.get(ADVISORY)) == sinks.TASK_BYTES[ADVISORY]
            assert spark.conf.get(SPLIT) == "1m"
        assert spark.conf.get(ADVISORY, None) == before[ADVISORY] and spark.conf.get(SPLIT) == "1m"
    finally:
        spark.conf.unset(SPLIT) if before[SPLIT] is None else spark.conf.set(SPLIT, before[SPLIT])


def test_a_month_is_written_by_as_many_tasks_as_its_size_asks(spark, monkeypatch):
    monkeypatch.setitem(sinks.TASK_BYTES, ADVISORY, 256 << 10)
    rows = spark.range(0, 300_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"), F.lit("2025-03-07").cast("date").alias("day"))
    path = f"{tempfile.mkdtemp(prefix='lapsekit-bounded-')}/t"
    back = sinks.materialise(rows, path, partition_month="day", cluster=["id"])
    files = [f for f in os.listdir(f"{path}/activity_month=2025-03-01") if f.endswith(".parquet")]
    assert len(files) >= 8                                         # one, were a task to take in 64 MB
    assert back.count() == 300_000 and back.columns == rows.columns


def test_derived_columns_are_made_after_the_shuffle(spark):
    rows = spark.range(1000).select("id", F.lit("2025-03-07").cast("date").alias("day"))
    path = f"{tempfile.mkdtemp(prefix='lapsekit-derived-')}/t"
    back = sinks.materialise(rows, path, partition_month="day", cluster=["id"], keep_month=True,
                             derive=lambda r: r.withColumn("twice", F.col("id") * 2))
    assert back.columns == ["id", "day", "twice", "activity_month"]
    assert back.filter("twice = 2 * id AND activity_month = DATE '2025-03-01'").count() == 1000


def test_events_are_the_same_in_one_step_and_in_two(golden):
    from lapsekit.operators.events import resolve_events, unify_events, with_period_columns
    parts = golden.stg_coupons, golden.stg_cashback, golden.stg_identity, golden.spec
    two = with_period_columns(resolve_events(*parts).withColumn("kept", F.lit(1)), golden.spec)
    one = unify_events(*parts)
    assert two.columns == [*one.columns, "kept"]
    assert one.exceptAll(two.drop("kept")).isEmpty() and two.drop("kept").exceptAll(one).isEmpty()
