"""Runs registered queries beside their DuckDB SQL and compares the rows.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.tz_localize(None).isoformat() if value.tzinfo else value.isoformat()
    if isinstance(value, bool) or hasattr(value, "dtype") and value.dtype == bool:
        return bool(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_plain(v) for v in row) for row in frame.astype(object).itertuples(index=False)), key=repr)


def kind_of(frame: pd.DataFrame) -> dict[str, str]:
    return {c: frame[c].dtype.kind for c in sorted(frame.columns)}


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    kinds = [c for c, k in kind_of(got).items() if k != kind_of(want)[c] and got[c].notna().any() and want[c].notna().any()]
    if kinds:
        return f"types {[(c, str(got[c].dtype), str(want[c].dtype)) for c in kinds]}"
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    different = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def main() -> None:
    import __spark_entry__ as contract
    from holdfast.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = local_session("oracle"), connect(sf_dir)
    oracle = contract.oracle_sql()
    bad = 0
    for name, build in contract.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            got = build(spark, sf_dir).toPandas()
            took = time.time() - started
            outcome = "rows only" if name not in oracle else compare(got, con.execute(oracle[name]).df())
            rows = len(got)
        except Exception as e:  # report and go on with the next query
            outcome, rows, took = f"{type(e).__name__}: {str(e)[:600]}", -1, time.time() - started
        bad += outcome not in ("", "rows only")
        print(f"{name:24s} rows={rows:6d} {took:6.2f}s {outcome or 'ok'}", flush=True)
    print("failed", bad)


if __name__ == "__main__":
    main()
