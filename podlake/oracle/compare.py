"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

from ..sources.tables import DRIVER_TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    """(equal, message): column names, row count, values (floats to 9 digits)."""
    cols = df.columns
    rows = [tuple(norm(v) for v in r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = [tuple(norm(v) for v in r) for r in cur.fetchall()]
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {cols} vs {ocols}"
    order = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in order) for r in orows]
    a, b = sorted(rows, key=_key), sorted(orows, key=_key)
    if len(a) != len(b):
        return False, f"row count {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first difference: spark={str(x)[:300]} oracle={str(y)[:300]}"
    return True, f"{len(a)} rows"
