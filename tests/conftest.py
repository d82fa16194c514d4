"""One Spark session for all tests, and the shared small tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("prepmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "2000")  # plans show all pushed filters
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config(
            "spark.driver.extraJavaOptions",
            f"-Dderby.stream.error.file={tmp_path_factory.mktemp('derby')}/derby.log",
        )
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trees(spark):
    rows = [("oak", 30), ("birch", 18), ("pine", 40), ("yew", 12), ("elm", 30), ("larch", 30)]
    return spark.createDataFrame(rows, "tree string, height bigint")


@pytest.fixture(scope="session")
def readings(spark):
    """A row of nulls, single nulls in two columns, a repeated row and an outlier."""
    north = [("north", 1, 20), ("north", 2, 25), ("north", 3, None), ("north", 9, 21)]
    south = [("south", 1, 70), ("south", 1, 70), ("south", None, 64), ("south", 4, 900), ("south", 5, 66)]
    return spark.createDataFrame([*north, (None, None, None), *south], "sensor string, day bigint, level bigint")
