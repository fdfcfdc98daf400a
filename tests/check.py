"""Run registered queries against their SQL in DuckDB.

python tests/check.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or str(v) == "<NA>":
        return None
    if hasattr(v, "item") and not isinstance(v, (list, dict)):
        try:
            v = v.item()
        except ValueError:
            pass
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return str(v) if not isinstance(v, (int, bool, str)) else v


def _rows(frame):
    columns = sorted(frame.columns)
    out = [tuple(_cell(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)]
    return columns, sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_frame, duck_frame) -> str:
    """Empty when equal, otherwise what differs."""
    a, b = spark_frame.toPandas(), duck_frame
    ca, ra = _rows(a)
    cb, rb = _rows(b)
    if ca != cb:
        return f"columns {ca} vs {cb}"
    kinds = [(c, str(a[c].dtype), str(b[c].dtype)) for c in ca]
    bad = [k for k in kinds if k[1] != k[2] and not (k[1] in ("object", "str") and k[2] in ("object", "str"))]
    # a null turns an integer column of either engine into floats, so compare kinds only then
    bad = [k for k in bad if not (a[k[0]].isna().any() or b[k[0]].isna().any())]
    if bad:
        return f"types {bad}"
    if len(ra) != len(rb):
        return f"rows {len(ra)} vs {len(rb)}"
    norm = lambda rows: [tuple(repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r) for r in rows]
    wrong = [(x, y) for x, y in zip(norm(ra), norm(rb)) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> None:
    import __spark_entry__ as e
    from cartlens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    folder = f"/root/testdata/sf{sf}"
    spark = local_session("check", cores="8")
    con = duck(folder)
    queries, oracles = e.queries(), e.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if prefixes and not any(name == p or name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                message = compare(df, con.execute(oracles[name]).df())
            else:
                message, rows = "", len(df.toPandas())
        except Exception as ex:
            message = f"{type(ex).__name__}: {str(ex)[:600]}"
        took = time.time() - start
        status = "ok  " if not message else "FAIL"
        if message:
            failed.append(name)
        extra = "" if name in oracles else " (rows only)"
        print(f"{status} {name}{extra} {took:.1f}s {message}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
