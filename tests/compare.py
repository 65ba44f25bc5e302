"""Runs queries in Spark and their SQL in DuckDB and compares all rows."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        src = p if p.is_file() else f"{p}/*.parquet"
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{src}')")
    return con


def plain(v: object) -> object:
    if v is None or isinstance(v, float) and math.isnan(v):
        return None if v is None else "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 9)
    return v


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, folder: str, query, sql: str) -> str:
    """Empty if all is equal, else what differs."""
    df = query(spark, folder)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(folder).execute(sql)
    names = [x[0] for x in cur.description]
    b = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(a) != len(b):
        return f"{len(a)} rows in Spark, {len(b)} in SQL; e.g. {[x for x in a if x not in set(b)][:2]} and {[x for x in b if x not in set(a)][:2]}"
    for x, y in zip(a, b):
        if x != y and any(p != q and not (isinstance(p, (int, float)) and isinstance(q, (int, float)) and math.isclose(p, q, rel_tol=1e-9)) for p, q in zip(x, y)):
            return f"{x} and {y}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as e

    from talkloom.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    names = sys.argv[2:] or sorted(e.queries())
    import time

    for n in names:
        t = time.time()
        if n not in e.oracle_sql():
            print(n, e.queries()[n](spark, folder).count(), "rows, no SQL", f"{time.time() - t:.1f} s", flush=True)
        else:
            try:
                r = compare(spark, folder, e.queries()[n], e.oracle_sql()[n])
            except Exception as x:  # noqa: BLE001
                r = f"{type(x).__name__}: {str(x)[:600]}"
            print(n, r or "equal", f"{time.time() - t:.1f} s", flush=True)
