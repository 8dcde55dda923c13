from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("daymark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture()
def make_orders(spark):
    from daymark import schemas as S

    def _make(rows):
        return spark.createDataFrame(rows, S.ORDERS)

    return _make


@pytest.fixture()
def make_events(spark):
    from daymark import schemas as S

    def _make(rows):
        return spark.createDataFrame(rows, S.EVENTS)

    return _make


@pytest.fixture()
def make_users(spark):
    from daymark import schemas as S

    def _make(rows):
        return spark.createDataFrame(rows, S.USERS)

    return _make
