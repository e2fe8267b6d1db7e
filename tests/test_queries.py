import duckdb
import pytest

import __spark_entry__ as entry_module
from feedloom.plans.oracle import all_oracles
from feedloom.plans.queries import all_queries

TABLES = ("nation", "customer", "orders", "lineitem")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_what_sql_gives(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    want = cursor.fetchall()
    assert by_name(df.columns, rows) == by_name([c[0] for c in cursor.description], want)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 19
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
