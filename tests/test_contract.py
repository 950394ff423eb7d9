import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from rollforward.plans.catalog import QUERIES
from rollforward.plans.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(str([plain(r[i]) for i in order]) for r in records)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_contract_holds_all_queries():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = canonical(names, cursor.fetchall())
    assert expected and found == expected
