"""Compare registered queries with their SQL in DuckDB: names, types, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(picked, key=_key)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Number of rows when both sides agree; raises otherwise."""
    rel = con.sql(sql)
    theirs_types = dict(zip(rel.columns, map(str, rel.types)))
    mine_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    assert mine_types == theirs_types, (mine_types, theirs_types)
    mine_names, mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    names, theirs = _rows(rel.columns, rel.fetchall())
    assert mine_names == names
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    for a, b in zip(mine, theirs):
        assert all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=0, abs_tol=0))
            for x, y in zip(a, b)
        ), (a, b)
    return len(mine)
