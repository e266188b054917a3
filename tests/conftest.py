import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from revpulse.schemas import ENTITIES
from revpulse.session import configure

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = configure(
        SparkSession.builder.master("local[*]"),
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(home / "shared"),
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    ).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("base tables are not available")
    return DATA


def parsed(value, dtype):
    """Python value for a typed column from the short text used in the tests."""
    kind = dtype.simpleString()
    if value is None or not isinstance(value, (str, int, float)):
        return value
    if kind == "date":
        return dt.date.fromisoformat(value)
    if kind == "timestamp_ntz":
        return dt.datetime.fromisoformat(value)
    if kind.startswith("decimal"):
        return Decimal(str(value))
    return value


@pytest.fixture
def entity(spark):
    """Build a source entity from dicts; columns left out are null."""

    def build(name, *rows):
        schema = ENTITIES[name].schema
        unknown = {c for r in rows for c in r} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([[parsed(r.get(f.name), f.dataType) for f in schema] for r in rows], schema)

    return build


@pytest.fixture
def frame(spark):
    """Build any frame from a DDL schema and tuples."""

    def build(schema, *rows):
        from pyspark.sql.types import StructType

        fields = StructType.fromDDL(schema)
        return spark.createDataFrame([[parsed(v, f.dataType) for v, f in zip(r, fields)] for r in rows], fields)

    return build


def by(df, key):
    """Rows of a frame as dicts, by one column."""
    return {r[key]: r.asDict() for r in df.collect()}
