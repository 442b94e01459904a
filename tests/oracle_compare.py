"""Compare registered Spark queries with their DuckDB SQL on the same parquet files.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_diff(df, con, sql):
    """Columns whose Spark type does not map to the DuckDB type of the oracle."""
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in df.schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {k: (v, d.get(k)) for k, v in s.items() if v != d.get(k)}


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        if name not in sql:
            out[name] = f"rows-only {len(s_rows)}"
            if verbose:
                print(f"{name:28s} {out[name]}  {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            res = con.execute(sql[name])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            out[name] = f"DUCK ERROR {str(e)[:300]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        types = type_diff(df, con, sql[name]) if sorted(s_cols) == sorted(d_cols) else {}
        if sorted(s_cols) != sorted(d_cols):
            out[name] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        elif types:
            out[name] = f"TYPES {types}"
        elif len(s_rows) != len(d_rows):
            out[name] = f"ROWCOUNT spark={len(s_rows)} duck={len(d_rows)}"
        else:
            a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
            if a == b:
                out[name] = f"OK {len(s_rows)}"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                out[name] = f"VALUES differ, e.g. {diff}"
        if verbose:
            print(f"{name:28s} {out[name]}  {time.time() - t0:.1f}s", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from headway.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
