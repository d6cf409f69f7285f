"""Spark result against its SQL counterpart: names, row count and values."""

from __future__ import annotations

import datetime
import math

TABLES = "region nation customer supplier part orders lineitem".split()


def duckdb_views(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql, limit=3):
    """Empty when both sides hold the same rows under the same names."""
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    dc, dr = rows_of([d[0] for d in cur.description], cur.fetchall())
    if sc != dc:
        return [f"columns {sc} / {dc}"]
    if sr == dr:
        return []
    a, b = set(sr), set(dr)
    return [f"rows {len(sr)} / {len(dr)}; only spark {sorted(a - b)[:limit]}; only sql {sorted(b - a)[:limit]}"
            f" ({len(a - b)}, {len(b - a)})"]
