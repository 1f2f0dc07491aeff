from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillstream.session import configure  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    )
    session = configure(builder, shuffle_partitions=4).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
