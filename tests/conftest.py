import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from support import FIXTURES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]").appName("lapsekit-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lapsekit-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def golden(spark):
    from lapsekit.plans.layers import Layers
    from lapsekit.sources.adapter import csv_inputs
    return Layers(csv_inputs(spark, FIXTURES))

