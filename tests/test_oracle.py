"""Every query equals its SQL, engine against engine, over the whole test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def as_multiset(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert as_multiset(df.columns, df.collect()) == as_multiset(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_contract(spark):
    assert set(ORACLE) <= set(contract.queries())
    assert contract.entry(spark).count() == 10
