from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"
STATE_STORE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("rillflow-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def lines(spark, tmp_path):
    """Text lines as a DataFrame read from a file."""
    from rillflow.sources import text_lines

    def read(rows):
        path = tmp_path / "lines.txt"
        path.write_text("\n".join(rows))
        return text_lines(spark, str(path))

    return read
