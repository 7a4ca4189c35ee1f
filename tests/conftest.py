from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopledger_checks.compare import connect  # noqa: E402
from shopledger_checks.fixtures import fixture_tables  # noqa: E402
from shopledger import Tables  # noqa: E402
from shopledger.sources.schemas import SCHEMAS  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shopledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        # Not UTC on purpose: no result may depend on the session's zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark) -> Tables:
    return fixture_tables(spark, SMALL)


@pytest.fixture(scope="session")
def duck():
    opened = {}

    def get(directory: str):
        if directory not in opened:
            opened[directory] = connect(directory)
        return opened[directory]

    return get


def frame_of(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """A business table from partial rows; what a row leaves out is NULL."""
    schema = spark.createDataFrame([], SCHEMAS[table]).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@pytest.fixture
def made(spark):
    """``made(table=[rows], ...)``: Tables over literal rows, the others empty."""

    def build(**rows: list[dict]) -> Tables:
        return Tables(lambda name: frame_of(spark, name, rows.get(name, [])))

    return build


@pytest.fixture
def values():
    """Rows of a frame as plain tuples."""
    return lambda frame: [tuple(r) for r in frame.collect()]


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
