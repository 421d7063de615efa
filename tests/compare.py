"""Exact comparison of a Spark result with a DuckDB result."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return v


def _types(values):
    return {type(v).__name__ for v in values if v is not None}


def differences(df, con, sql):
    """Empty list if both sides have the same columns, value kinds and rows."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expected = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: {sorted(set(names) ^ set(df.columns))}"]
    order = [names.index(c) for c in sorted(names)]
    got = [tuple(map(_plain, r)) for r in df.select(*sorted(df.columns)).collect()]
    want = [tuple(_plain(r[i]) for i in order) for r in expected]
    out = []
    if len(got) != len(want):
        out.append(f"rows: {len(got)} instead of {len(want)}")
    if not want:
        out.append("the oracle has no rows")
    for i, c in enumerate(sorted(names)):
        a, b = _types(r[i] for r in got), _types(r[i] for r in want)
        if a != b:
            out.append(f"{c}: kinds {a} instead of {b}")
        elif Counter(r[i] for r in got) != Counter(r[i] for r in want):
            x, y = Counter(r[i] for r in got), Counter(r[i] for r in want)
            out.append(f"{c}: values differ, extra {list((x - y).items())[:4]}, missing {list((y - x).items())[:4]}")
    if not out and Counter(got) != Counter(want):
        out.append("rows differ although each column agrees")
    return out
