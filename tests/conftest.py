import datetime as dt
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="barwright-tests-")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("barwright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{root}/shared")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    """The given small tables, whole. TEST_SF_DIR names others."""
    return os.environ.get("TEST_SF_DIR", TABLES)


@pytest.fixture
def folder(tmp_path):
    """A new scratch folder per test."""
    return str(tmp_path)


BARS = "Date date, Ticker string, Open double, High double, Low double, Close double, Volume bigint"


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def series(ticker, n, start=0, step=1):
    """``n`` bars of a ticker with whole prices that differ from day to day."""
    return [
        (day(start + i * step), ticker, 30.0 + i * 7 % 11, 40.0 + i % 5, 20.0 - i % 3, 31.0 + i * i % 13, 1000 + i)
        for i in range(n)
    ]


def rows(df, *columns):
    """Rows as sorted tuples; NaN compares equal to itself as text."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(str(v) for v in r) for r in picked.collect()))
