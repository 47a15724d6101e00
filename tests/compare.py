"""Compare a Spark result with a DuckDB result, row order aside."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if value != value else format(value, ".12g")
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# Type names of the two engines.
TYPES = {"string": "VARCHAR", "int": "INTEGER", "date": "DATE", "bigint": "BIGINT", "double": "DOUBLE"}


def differences(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    ours = _rows(df.columns, df.collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"row {[(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]}"
    types = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    wrong = [(c, t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]]
    return f"types {wrong}" if wrong else None
