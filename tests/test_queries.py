"""Every registered query against its SQL, at the smallest scale."""

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import ORACLES, QUERIES
from workload.views import TABLES

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, engine, name):
    result = QUERIES[name](spark, str(FOLDER))
    columns = sorted(result.columns)
    ours = Counter(
        tuple(plain(v) for v in r) for r in result.select([f"`{c}`" for c in columns]).collect()
    )
    relation = engine.execute(ORACLES[name])
    names = [c[0] for c in relation.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert columns == [names[i] for i in order]
    expected = Counter(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    assert sum(expected.values()) > 0
    assert ours == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
