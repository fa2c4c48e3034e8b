"""Row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    # Spark's order of NULLs.
    con.execute("SET default_null_order = 'nulls_first_on_asc_last_on_desc'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, bool) or v is None or isinstance(v, (str, dt.date, dt.datetime)):
        return v
    if isinstance(v, float):
        return repr(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows_of(names, cur.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if actual == expected:
        return None if sum(actual.values()) else "EMPTY"
    extra, missing = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} against {sum(expected.values())}; only Spark {sum(extra.values())}: "
        f"{list(extra)[:2]}; only SQL {sum(missing.values())}: {list(missing)[:2]}"
    )
