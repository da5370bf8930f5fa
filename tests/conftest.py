import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from partnerlens.session import prepare_session

    s = (SparkSession.builder.master("local[4]").appName("partnerlens-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pl-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    prepare_session(s)
    yield s


@pytest.fixture(scope="session")
def models(spark):
    from partnerlens.plans.models import Models

    return Models.from_fixture(spark, SF0001, materialize="parquet")
