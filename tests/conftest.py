import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make(spark):
    """Readings of several series: {name: values} at one value a minute, or explicit minutes."""

    def build(series, minutes=None):
        rows, key = [], 0
        for name, values in series.items():
            at = minutes[name] if minutes else range(len(values))
            for m, v in zip(at, values):
                rows.append((key, START + dt.timedelta(minutes=float(m)), name, None if v is None else float(v)))
                key += 1
        return spark.createDataFrame(rows, "row_key bigint, time timestamp, entity_id string, value double")

    return build
