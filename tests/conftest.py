from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from activitykit.schema import RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("activitykit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def raw_row(
    event_time="2019-10-01 00:00:00 UTC",
    event_type="view",
    product_id=1001,
    category_id=2001,
    category_code="electronics.audio",
    brand="sony",
    price=10.5,
    user_id=3001,
    user_session="session-a",
):
    return (event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session)


@pytest.fixture
def raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make


@pytest.fixture
def out_dir(tmp_path):
    return str(tmp_path)


def plan_text(df, mode: str = "simple") -> str:
    """The physical plan as ``df.explain(mode)`` prints it (AQE's initial plan included)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
