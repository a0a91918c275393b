"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (v if os.environ.get("EXACT_FLOATS") else round(v, 9))
    if isinstance(v, (np.floating,)):
        return None if np.isnan(v) else (float(v) if os.environ.get("EXACT_FLOATS") else round(float(v), 9))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm_value(x) for x in v)
    if isinstance(v, (dt.datetime, )):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def spark_to_duck_type(t) -> str:
    from pyspark.sql import types as T
    if isinstance(t, T.ArrayType):
        return spark_to_duck_type(t.elementType) + "[]"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
            "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT"}.get(t.simpleString(), t.simpleString())


def rows_of(records, cols):
    return sorted((tuple(norm_value(r[c]) for c in cols) for r in records), key=repr)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from quarry.plans.catalog import ORACLE, QUERIES
    from quarry.session import local_session
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = 0
    todo = names or list(QUERIES)
    for name in todo:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            s_cols = sorted(sdf.columns)
            s_rows = [r.asDict(recursive=True) for r in sdf.collect()]
            t1 = time.time()
            if name not in ORACLE:
                print(f"{name:22s} rows-only  spark={len(s_rows)}  {t1 - t0:.1f}s", flush=True)
                continue
            rel = con.sql(ORACLE[name])
            d_cols = sorted(rel.columns)
            d_recs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
            t2 = time.time()
            same_cols = s_cols == d_cols
            s_types = {f.name: spark_to_duck_type(f.dataType) for f in sdf.schema.fields}
            d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
            type_diff = {c: (s_types.get(c), d_types.get(c)) for c in s_cols if s_types.get(c) != d_types.get(c)}
            a = rows_of(s_rows, s_cols)
            b = rows_of(d_recs, d_cols) if same_cols else []
            match = same_cols and a == b
            ok += match
            msg = "OK " if match else "BAD"
            print(f"{name:22s} {msg} spark={len(a)} duck={len(d_recs)} {t1 - t0:.1f}s/{t2 - t1:.1f}s"
                  + (f"  TYPES {type_diff}" if type_diff else ""), flush=True)
            if not same_cols:
                print("   cols spark", s_cols, "\n   cols duck ", d_cols)
            elif not match:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:2])
                print("   only duck :", list(sb - sa)[:2])
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} ERROR {type(e).__name__}: {str(e)[:600]}", flush=True)
    print(f"{ok}/{len([n for n in todo if n in ORACLE])} oracle matches")


if __name__ == "__main__":
    main()
