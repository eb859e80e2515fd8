"""Compare a Spark result with DuckDB's answer to the SQL twin, as multisets of rows."""

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = ("customer", "orders", "events")


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    return float(value) if isinstance(value, int) else value


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(map(_plain, row)) for row in rows)


def duckdb_rows(sql, sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows
