"""Shared session and synthetic tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

from oddrow.sources.storage import Scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("oddrow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    made = Scratch(spark)
    yield made
    made.drop()


@pytest.fixture
def make_csv(tmp_path):
    """Write a table as one CSV file with a header and return its path."""

    def write(table: pd.DataFrame, name: str = "data.csv", **options) -> str:
        path = tmp_path / name
        table.to_csv(path, index=False, **options)
        return str(path)

    return write
