import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="tidemart-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    s = (SparkSession.builder.master("local[4]").appName("tidemart-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tidemart.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


RAW_SST_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("sst_celsius", T.DoubleType()), T.StructField("sea_ice_fraction", T.DoubleType()),
])
RAW_SLA_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("sea_level_anomaly_m", T.DoubleType()),
])

# literal fixture: four 0.05 degree SST points in the cell (0, 10) plus one Arctic point
RAW_SST_ROWS = [
    (1993, 1, 0.00, 10.00, 25.0, 0.00),
    (1993, 1, 0.05, 10.00, 27.0, 0.00),
    (1993, 1, 0.10, 10.05, 26.0, 0.00),
    (1993, 1, 0.12, 10.10, 28.0, 0.00),
    (1993, 1, 70.00, 20.00, -1.5, 0.80),
]
# SLA already on the 0.25 degree grid
RAW_SLA_ROWS = [
    (1993, 1, 0.00, 10.00, 0.05),
    (1993, 1, 70.00, 20.00, 0.12),
]


@pytest.fixture
def raw_sst(spark):
    return spark.createDataFrame(RAW_SST_ROWS, RAW_SST_SCHEMA)


@pytest.fixture
def raw_sla(spark):
    return spark.createDataFrame(RAW_SLA_ROWS, RAW_SLA_SCHEMA)
