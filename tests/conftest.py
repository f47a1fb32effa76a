from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from checks.compare import connect

    return connect(sf_dir)


@pytest.fixture(scope="session")
def make_payments(spark):
    """Payments with the declared schema from partial rows; ids are filled in."""
    from payscope.sources.schema import ID, PAYMENTS

    def make(rows: list[dict]):
        full = [
            tuple({ID: f"P{i}", **row}.get(f.name) for f in PAYMENTS.fields)
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(full, PAYMENTS)

    return make


@pytest.fixture(scope="session")
def make_ruca(spark):
    from payscope.sources.schema import RUCA

    return lambda rows: spark.createDataFrame(rows, RUCA)


def plan_text(df, mode: str = "simple") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
