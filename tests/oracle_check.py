"""Compare every ``queries()`` key with its DuckDB oracle on one scale factor.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``. Prints one line
per key and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01"))) if v == v else None
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict[str, tuple[bool, str]]:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
            ts = time.time() - t0
            if key not in sqls:
                results[key] = (True, f"rows={len(s_rows)} (no oracle) spark={ts:.1f}s")
                continue
            cur = con.execute(sqls[key])
            d_cols = [c[0] for c in cur.description]
            d_cols, d_rows = rows_of(d_cols, cur.fetchall())
            if s_cols != d_cols:
                results[key] = (False, f"columns differ: spark={s_cols} duckdb={d_cols}")
            elif len(s_rows) != len(d_rows):
                results[key] = (False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}")
            elif s_rows != d_rows:
                diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
                results[key] = (False, f"values differ ({len(s_rows)} rows), first: {diff}")
            else:
                results[key] = (True, f"rows={len(s_rows)} spark={ts:.1f}s")
        except Exception as e:  # report and continue with the next key
            results[key] = (False, f"error: {type(e).__name__}: {str(e)[:600]}")
        if verbose:
            ok, msg = results[key]
            print(f"{'OK ' if ok else 'BAD'} {key:28s} {msg}", flush=True)
    return results


if __name__ == "__main__":
    from carelake.session import build_session
    args = sys.argv[1:]
    vanilla = "--vanilla" in args           # a session with Spark's defaults only
    args = [a for a in args if a != "--vanilla"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or None
    if vanilla:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, keys)
    bad = [k for k, (ok, _) in res.items() if not ok]
    print(f"{len(res) - len(bad)}/{len(res)} match", "bad:", bad)
    sys.exit(1 if bad else 0)
