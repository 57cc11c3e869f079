"""Run queries against their SQL twins in DuckDB, rows compared as sorted lists of plain values.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(values: pd.Series) -> str:
    kind = values.dtype.kind
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(kind, "object")


def plain(df: pd.DataFrame) -> tuple[dict[str, str], list[tuple]]:
    df = df.reindex(sorted(df.columns), axis=1)
    columns = {}
    for name in df.columns:
        columns[name] = _kind(df[name])
    out = df.astype(object).where(df.notna(), None)
    rows = [tuple(str(pd.Timestamp(v)) if hasattr(v, "year") else (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
                  for v in row) for row in out.itertuples(index=False, name=None)]
    return columns, sorted(rows, key=repr)


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    """Empty when equal, else what differs first."""
    a, b = plain(spark_df), plain(sql_df)
    if list(a[0]) != list(b[0]):
        return f"columns {list(a[0])} <> {list(b[0])}"
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} <> {len(b[1])}"
    if len(a[1]) and a[0] != b[0]:
        odd = {k: (a[0][k], b[0][k]) for k in a[0] if a[0][k] != b[0][k] and {a[0][k], b[0][k]} != {"object", "time"}}
        if odd:
            return f"types {odd}"
    for x, y in zip(a[1], b[1]):
        if x != y:
            return "first difference:\n   " + repr([(c, i, j) for c, i, j in zip(a[0], x, y) if i != j])
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from txnwatch.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = build_session(8), connect(sf_dir)
    runs, sql, bad = queries(), oracle_sql(), 0
    for name in names or runs:
        try:
            started = time.time()
            got = runs[name](spark, sf_dir).toPandas()
            took = time.time() - started
            if name in sql:
                started = time.time()
                want = con.execute(sql[name]).df()
                said = compare(got, want)
                print(f"{'OK  ' if not said else 'FAIL'} {name} {len(got)} rows {took:.2f}s duckdb {time.time() - started:.2f}s {said}", flush=True)
                bad += bool(said)
            else:
                print(f"ROWS {name} {len(got)} rows {took:.2f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            text = str(error).split("JVM stacktrace")[0][:700]
            print(f"ERR  {name} {type(error).__name__}: {text}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
