"""Run registered queries against their DuckDB twins (order-insensitive).

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def _canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, sf_dir: str, keys=None, con=None):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for k in keys or qs:
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_names, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:  # noqa: BLE001
            results[k] = ("spark-error", repr(e)[:400])
            continue
        st = time.time() - t
        if k not in sql:
            results[k] = ("rows-only", len(s_rows), round(st, 2))
            continue
        try:
            rel = con.sql(sql[k])
            d_names, d_rows = _canon(rel.columns, rel.fetchall())
        except Exception as e:  # noqa: BLE001
            results[k] = ("duck-error", repr(e)[:400])
            continue
        ok = s_names == d_names and s_rows == d_rows
        info = (len(s_rows), len(d_rows))
        if not ok:
            diff = [r for r in s_rows if r not in set(d_rows)][:2]
            diff2 = [r for r in d_rows if r not in set(s_rows)][:2]
            results[k] = ("MISMATCH", info, s_names, d_names, diff, diff2)
        else:
            results[k] = ("ok", info, round(st, 2))
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from dailytally.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, keys)
    bad = 0
    for k, v in res.items():
        print(k, *v)
        bad += v[0] not in ("ok", "rows-only")
    print("FAILED" if bad else "ALL OK", bad)
