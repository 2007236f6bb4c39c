"""Compare a query's rows with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return value.normalize() + 0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


# Spark and DuckDB names of the same type.
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def _type(spark_type: str) -> str:
    return _TYPES.get(spark_type, spark_type.upper())


def mismatches(con, df, sql: str) -> list[str]:
    """Differences in column names, types, row count or values."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]).replace(" ", "") for d in result.description}
    theirs_names = [d[0] for d in result.description]
    theirs = result.fetchall()
    ours_types = {n: _type(t) for n, t in df.dtypes}
    if sorted(ours_types) != sorted(theirs_types):
        return [f"columns {sorted(ours_types)} != {sorted(theirs_types)}"]
    problems = [f"type of {n}: {t} != {theirs_types[n]}" for n, t in ours_types.items() if t != theirs_types[n]]
    order = sorted(ours_types)
    ours = Counter(tuple(_plain(row[n]) for n in order) for row in df.collect())
    places = [theirs_names.index(n) for n in order]
    expected = Counter(tuple(_plain(row[i]) for i in places) for row in theirs)
    if ours != expected:
        extra, lacking = list((ours - expected).items())[:2], list((expected - ours).items())[:2]
        problems.append(f"rows {sum(ours.values())} vs {sum(expected.values())}; ours {extra}; theirs {lacking}")
    if not ours:
        problems.append("no rows")
    return problems
