"""Run a query on Spark and its SQL on DuckDB and compare schema, row count and values."""

from __future__ import annotations

import math
import pathlib

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def differences(df, con, sql: str, tolerance: float = 0.0) -> list[str]:
    cols = sorted(df.columns)
    relation = con.execute(f"select * from ({sql})")
    found = {d[0]: str(d[1]) for d in relation.description}
    out = []
    if sorted(found) != cols:
        return [f"columns: only Spark {set(cols) - set(found)}, only SQL {set(found) - set(cols)}"]
    kinds = dict(df.dtypes)
    out += [
        f"type of {c}: {kinds[c]} and {found[c]}" for c in cols if TYPES.get(kinds[c], kinds[c]).upper() != found[c].upper()
    ]
    order = [list(found).index(c) for c in cols]
    theirs = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=_key)
    ours = sorted((tuple(row[c] for c in cols) for row in df.select(*[f"`{c}`" for c in cols]).collect()), key=_key)
    if len(ours) != len(theirs):
        return [*out, f"rows: {len(ours)} and {len(theirs)}"]
    wrong = {}
    for a, b in zip(ours, theirs):
        for c, x, y in zip(cols, a, b):
            if not _same(x, y, tolerance):
                wrong.setdefault(c, []).append((x, y))
    return out + [f"{c}: {len(v)} differ, e.g. {v[:3]}" for c, v in wrong.items()]


def _same(x, y, tolerance) -> bool:
    if isinstance(x, float) and math.isnan(x):
        return False
    if isinstance(x, float) and isinstance(y, float) and tolerance:
        return abs(x - y) <= tolerance
    if isinstance(x, float) and isinstance(y, float):
        return x == y and math.copysign(1, x) == math.copysign(1, y)
    return x == y
