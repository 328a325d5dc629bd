import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from retailflow.session import DEFAULT_CONF, ensure_checkpoint_dir

    warehouse = tempfile.mkdtemp(prefix="retailflow-wh-")
    b = (SparkSession.builder.master("local[*]").appName("retailflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", warehouse)
         .config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def db(spark):
    """A fresh database name per test (tables live in the temp warehouse)."""
    import uuid

    name = "t_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {name}")
    return name
