"""Every registered query against its SQL in DuckDB, whole rows and exact values."""

import pytest

import __spark_entry__ as driver
from wattspan.plans import catalog, oracles

QUERIES = catalog.QUERIES
ORACLES = oracles.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    relation = duck.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    actual = sorted((tuple(row[c] for c in columns) for row in result.collect()), key=repr)
    assert len(actual) == len(expected)
    assert actual == expected


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.columns[:3] == ["window_start", "window_end", "region"]
    assert flagship.count() > 0
