"""Every registered query against its SQL twin on a whole scale factor."""

import pytest

import __spark_entry__ as contract
from subscriber_analytics.plans import oracles, registry
from tests.comparison import duckdb_rows, spark_rows

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


def test_every_query_has_a_twin_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = duckdb_rows(ORACLES[name], sf_dir)
    assert names == expected_names
    assert sum(rows.values()) > 0
    assert rows - expected == expected - rows == type(rows)(), (
        f"{sum((rows - expected).values())} of {sum(rows.values())} rows differ, "
        f"e.g. {next(iter(rows - expected), None)} against {next(iter(expected - rows), None)}"
    )


def test_entry(spark):
    assert contract.entry(spark).columns == ["contract", "nb_clients", "nb_churn", "taux_churn"]
