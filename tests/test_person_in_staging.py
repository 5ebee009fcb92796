"""Stored feeds carry their person: events and source profile join and shuffle the feeds no more."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lapsekit.operators.events import resolve_events, with_person
from lapsekit.operators.profile import source_profile
from lapsekit.plans.layers import Layers
from lapsekit.sources import sinks
from lapsekit.sources.adapter import RawInputs, csv_inputs
from support import FIXTURES


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def odd(spark):
    """The fixtures, with rows that name no id or an ambiguous one."""
    raw = csv_inputs(spark, FIXTURES)
    some = raw.coupons.limit(2)
    coupons = raw.coupons.unionByName(some.withColumns({"coupon_user_id": F.lit(None).cast("string"),
                                                        "coupon_event_id": F.concat(F.lit("null-"), "coupon_event_id")}))
    ids = raw.identity.filter("lower(trim(source_system)) = 'coupon'").limit(3).withColumn("unified_user_id", F.lit("someone else"))
    nameless = spark.createDataFrame([("coupon", None, "nobody")], raw.identity.select("source_system", "source_user_id", "unified_user_id").schema)
    return RawInputs(raw.identity.unionByName(ids, allowMissingColumns=True).unionByName(nameless, allowMissingColumns=True),
                     coupons, raw.cashback)


@pytest.mark.parametrize("name", ["stg_coupons", "stg_cashback", "events", "source_profile"])
def test_stored_equals_lazy_on_odd_ids(odd, golden, stored, name):
    _same(getattr(stored, name), getattr(Layers(odd, golden.spec), name))


@pytest.fixture(scope="module")
def stored(odd, golden):
    return Layers(odd, golden.spec, materialise=True)


def test_events_and_profile_of_stored_feeds_need_no_join(stored):
    feeds = stored.person_coupons, stored.person_cashback
    assert "Join" not in _plan(resolve_events(*feeds, stored.stg_identity, stored.spec))
    plain = stored.stg_coupons, stored.stg_cashback
    assert "Join" in _plan(resolve_events(*plain, stored.stg_identity, stored.spec))
    assert "stg_identity_map" not in " ".join(source_profile(feeds[1], stored.stg_identity, stored.spec).inputFiles())
    assert stored.events.filter("has_ambiguous_mapping").count() > 0
    assert stored.events.filter("is_unmapped_user AND source_user_id IS NULL").count() == 2


def test_a_person_is_never_doubled(golden):
    c = golden.stg_coupons
    got = with_person(c, golden.stg_identity, "coupon", "coupon_user_id")
    assert got.columns == [*c.columns, "unified_user_id", "has_ambiguous_mapping"]
    _same(got.select(*c.columns), c)


def test_rows_of_month_folders_stay_in_them(spark):
    rows = spark.range(400).select("id", F.expr("date_add(DATE '2025-01-01', cast(id % 90 AS int))").alias("day"))
    root = tempfile.mkdtemp(prefix="lapsekit-months-")
    first = sinks.materialise(rows, f"{root}/a", partition_month="day", cluster=["id"])
    again = sinks.materialise(first, f"{root}/b", partition_month="day", cluster=["id"], from_months=True)
    _same(again, rows)
    assert sorted(d for d in os.listdir(f"{root}/b") if d.startswith("activity")) == [f"activity_month=2025-0{m}-01" for m in (1, 2, 3)]
