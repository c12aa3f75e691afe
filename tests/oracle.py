"""Compare a Spark query with its DuckDB SQL, as multisets of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

from fieldlens.plans.views import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return float(f"{float(value):.9g}") if type(value).__name__ == "Decimal" else value


def differences(df, con, sql: str) -> tuple[list, list]:
    columns = sorted(df.columns)
    mine = Counter(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in cursor.fetchall())
    return list((mine - theirs))[:3], list((theirs - mine))[:3]
