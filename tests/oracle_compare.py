"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def canon(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in t))


def same(df, con, sql) -> tuple[bool, str]:
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    exp_cols = [d[0] for d in res.description]
    exp = res.fetchall()
    if sorted(got_cols) != sorted(exp_cols):
        return False, f"columns differ: {sorted(got_cols)} vs {sorted(exp_cols)}"
    if len(got) != len(exp):
        return False, f"rows differ: {len(got)} vs {len(exp)}"
    a, b = canon(got_cols, got), canon(exp_cols, exp)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        return False, f"values differ, e.g. {diff}"
    return True, ""
