"""Every registered query against its SQL on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path(contract.SMALL)
QUERIES, ORACLE = contract.QUERIES, contract.ORACLE_SQL

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="supplied tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    def plain(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(map(plain, r)) for r in rows)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    answer = duck.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert comparable(rows) == comparable(tuple(r[i] for i in order) for r in answer.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000
