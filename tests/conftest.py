import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyedlog import KeyedTable, TableSpec  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("keyedlog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_table(spark, tmp_path):
    def make(name="t", key="k", precombine="ts", partition=None):
        spec = TableSpec(name, str(tmp_path / name), key, precombine, partition)
        return KeyedTable(spark, spec)

    return make


@pytest.fixture
def frame(spark):
    def build(rows, schema="k string, p string, ts bigint, v bigint"):
        return spark.createDataFrame(rows, schema)

    return build
