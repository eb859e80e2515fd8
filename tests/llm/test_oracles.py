"""The SQL twins on the small tables."""

import duckdb
import pytest

from subscriber_analytics.llm import oracles, registry
from tests.llm.test_urls import PAGES, WANT

PATH = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_query_is_its_twin(spark, name):
    with duckdb.connect() as con:
        for table in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{table}.parquet'")
        found = con.execute(oracles.oracle_sql()[name])
        columns = [d[0] for d in found.description]
        want = found.fetchall()
    got = registry.queries()[name](spark, PATH)
    assert sorted(columns) == sorted(got.columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


def test_url_twin_follows_aliases():
    with duckdb.connect() as con:
        con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
        rows = con.execute(oracles.oracle_sql()["op5_url_filter"]).fetchall()
    assert len(rows) == len(PAGES) and all(WANT[r[0]] == r[1:] for r in rows)
