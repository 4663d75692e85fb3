import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillhouse.session import ensure_checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="tillhouse-tests-")
    s = (SparkSession.builder.master("local[*]").appName("tillhouse-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g")       # one session holds the state of the whole suite
         .config("spark.sql.ui.retainedExecutions", "20")
         .config("spark.ui.retainedJobs", "100")
         .config("spark.ui.retainedStages", "100")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.local.dir", os.path.join(scratch, "local"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):  # set our own only where none is configured
        s.conf.set("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch(spark):
    """A new scratch folder for tables the tests write."""
    return tempfile.mkdtemp(prefix="tillhouse-scratch-")


@pytest.fixture(scope="session")
def sf001_op(spark):
    from tillhouse.sources import store, testdata

    return store.persist_op(testdata.op_tables(spark, SF001))


@pytest.fixture(scope="session")
def sf001_dw(spark, sf001_op):
    import datetime as dt

    from tillhouse.plans import etl
    from tillhouse.sources import store

    return etl.first_load(sf001_op, dt.datetime(2002, 1, 1), initial_mark=dt.datetime(1990, 1, 1),
                          stage=store.parquet_stage).dw
