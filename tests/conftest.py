import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def same_rows(left, right) -> bool:
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        return False
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
