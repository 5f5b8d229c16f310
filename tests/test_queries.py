"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql(small):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in values)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_gives_the_rows_of_its_sql(spark, sql, small, name):
    df = contract.queries()[name](spark, small)
    got = rows(df.columns, df.collect())
    text = contract.oracle_sql().get(name)
    if text is None:
        assert got
        return
    result = sql.execute(text)
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows(names, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
