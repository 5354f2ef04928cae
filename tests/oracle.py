"""Compare a query with its SQL: same columns, same rows, in any order."""

from __future__ import annotations

import math
from datetime import datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=_key)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = rows_of(df.columns, df.collect()), rows_of(names, expected)
    if got != want:
        only_got, only_want = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
        return f"{len(got)} vs {len(want)} rows; only spark {only_got}; only sql {only_want}"
    expected_kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    odd = [f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if expected_kinds.get(t) != kinds[c]]
    return f"types {odd}" if odd else None
