"""Compare a registered query with its SQL statement, value by value."""

from __future__ import annotations

import datetime as dt
import decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return ("dec", format(value.normalize(), "f"))
    if isinstance(value, float):
        return ("nan",) if value != value else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "asDict"):
        return tuple(_norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(_norm(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((repr(tuple(_norm(r[i]) for i in order)) for r in rows))


def compare(con, df, sql) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    got_cols, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:3]
    missing = sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} vs {len(want)}\n  spark only: {extra}\n  sql only:   {missing}"
