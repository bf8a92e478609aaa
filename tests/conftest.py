from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import DataFrame, SparkSession

from shopledger.session import tune


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("shopledger-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_options(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_options
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def day(text: str) -> date:
    return date.fromisoformat(text)


def tuples(df: DataFrame) -> list[tuple]:
    """Rows in the order the plan gives them."""
    return [tuple(row) for row in df.collect()]


def bag(df: DataFrame) -> list[tuple]:
    """Rows without regard to order."""
    return sorted(tuples(df), key=repr)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
