"""Run a query and its SQL twin side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    rel = con.execute(sql)
    theirs = [d[0] for d in rel.description]
    if sorted(df.columns) != sorted(theirs):
        return f"columns {sorted(df.columns)} != {sorted(theirs)}"
    kinds = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
    mine = dict(df.dtypes)
    for d in rel.description:
        want = kinds.get(str(d[1]), str(d[1]))
        if mine[d[0]] != want:
            return f"type of {d[0]}: {mine[d[0]]} != {d[1]}"
    a, b = rows_of(df.columns, df.collect()), rows_of(theirs, rel.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{[(n, p, q) for n, p, q in zip(sorted(theirs), x, y) if p != q]}"
    return None
