import datetime as dt
import decimal
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="ledgerloom-tests-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]").appName("ledgerloom-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def cfg():
    from ledgerloom.config import ReconConfig
    return ReconConfig()


def D(x):
    return decimal.Decimal(str(x))


def day(s):
    return dt.date.fromisoformat(s)


def make(spark, table, rows):
    """A raw table from partial rows (missing declared columns are NULL)."""
    from pyspark.sql import types as T
    from ledgerloom.sources.schemas import RAW_SCHEMAS
    schema = RAW_SCHEMAS[table]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, nullable)
