import datetime as dt
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

# Python-side timestamps without a zone mean UTC, as in the session.
os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faremill import Settings
from faremill.functions.numbers import NUMERIC
from faremill.session import CHECKPOINT_DIR, prepare
from faremill.sources.raw import SCHEMAS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def settings():
    return Settings(as_of=dt.date(2024, 2, 15))


def ts(text: str) -> dt.datetime:
    """``'05 10:30:00'`` is 5 January 2024; a full date may be given instead."""
    return dt.datetime.fromisoformat(f"2024-01-{text}" if text[2] == " " else text)


@pytest.fixture
def rows(spark):
    """Build a raw table from dicts; missing columns are null, plain numbers become decimals."""

    def build(table: str, *records: dict):
        schema = SCHEMAS[table]

        def value(field, record):
            found = record.get(field.name)
            return Decimal(str(found)) if field.dataType == NUMERIC and found is not None else found

        return spark.createDataFrame([tuple(value(f, r) for f in schema) for r in records], schema)

    return build


@pytest.fixture
def raw(rows):
    """Six raw tables; those not given are empty."""

    def build(**tables):
        return {t: rows(t, *tables.get(t.removesuffix("_raw"), [])) for t in SCHEMAS}

    return build
