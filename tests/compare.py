"""Compare a Spark result with DuckDB rows, ignoring row and column order."""

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if value != value else f"{value + 0.0:.12g}"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


# Spark type -> DuckDB type of the same column.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in df.select(*names).collect())


def oracle_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    rows = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    return names, rows, kinds


def differences(df, con, sql):
    """Problems found, empty when both sides agree."""
    names, ours = rows_of(df)
    other, theirs, kinds = oracle_rows(con, sql)
    problems = []
    if names != other:
        return [f"columns {set(names) ^ set(other)}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        cells = [(n, x, y) for n, x, y in zip(names, *bad[0]) if x != y]
        problems.append(f"{len(bad)} rows differ, first: {cells[:6]}")
    return problems
