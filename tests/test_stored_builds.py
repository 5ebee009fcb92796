"""Stored builds: pruned reads, changed inputs, removal, and no machine-local folder on a cluster."""

import os
import shutil
import tempfile

import pyarrow.parquet as pq
import pytest

from lapsekit.plans import registry
from lapsekit.plans.layers import Layers
from lapsekit.sources import sinks
from lapsekit.sources.adapter import adapter_inputs
from lapsekit.spec import ADAPTER_SPEC

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return Layers(adapter_inputs(spark, SF), ADAPTER_SPEC, materialise=True)


def test_month_folders_are_pruned(spark, stored):
    import datetime as dt
    for df in (stored.period_events, stored.activity_as_of(dt.date(1996, 9, 30)), stored.transition_by_vintage,
               stored.active_base_by_vintage):
        plan = _plan(df)
        assert "PartitionFilters: [isnotnull(activity_month" in plan, plan[:2000]
        assert "PartitionFilters: []" not in plan.replace("PartitionFilters: [], PushedFilters: []", "")
    assert "activity_month" not in stored.events.columns + stored.period_events.columns


def test_changed_input_is_built_anew(spark):
    folder = tempfile.mkdtemp(prefix="lapsekit-sf-")
    for t in ("customer", "part", "orders", "lineitem", "events"):
        shutil.copy(f"{SF}/{t}.parquet", f"{folder}/{t}.parquet")
    before = registry.QUERIES["m03_stage_coupons"](spark, folder).count()
    location = registry.layers(spark, folder)._location
    some = pq.read_table(f"{SF}/lineitem.parquet").slice(0, 100)
    os.remove(f"{folder}/lineitem.parquet")                              # read-only, as copied
    pq.write_table(some, f"{folder}/lineitem.parquet")
    spark.catalog.refreshByPath(folder)
    assert registry.QUERIES["m03_stage_coupons"](spark, folder).count() == 100 < before
    assert not os.path.exists(location.removeprefix("file:"))            # the stale build is gone
    registry.layers(spark, folder).drop()


def test_drop_removes_files_and_catalog_entries(spark):
    L = Layers(adapter_inputs(spark, SF), ADAPTER_SPEC, materialise=True)
    L.fact.count()
    had = {t.name for t in spark.catalog.listTables() if t.name.startswith("lapsekit_")}
    L.drop()
    left = {t.name for t in spark.catalog.listTables() if t.name.startswith("lapsekit_")}
    assert len(had - left) == 1
    assert not os.path.exists(L._location.removeprefix("file:"))


def test_no_local_folder_on_a_cluster():
    sinks.check_local("local[4]")
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            sinks.check_local(master)
