"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: row count, column names, and an order-insensitive comparison
of the values (columns sorted by name). Values are compared exactly.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "FLOAT": "float", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
                 "SMALLINT": "smallint", "HUGEINT": "hugeint"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        return _norm(v.item())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, queries: dict, oracle: dict, name: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = queries[name](spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(s_rows), "spark_cols": sorted(s_cols)}
    if name not in oracle:
        res["status"] = "rows-only"
        return res
    cur = con.execute(oracle[name])
    o_cols = [c[0] for c in cur.description]
    o_rows = cur.fetchall()
    res.update(oracle_rows=len(o_rows), oracle_cols=sorted(o_cols))
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    o_types = {c[0]: str(c[1]) for c in cur.description}
    diff = {c: (s_types.get(c), o_types.get(c)) for c in s_types
            if DUCK_TO_SPARK.get(o_types.get(c), o_types.get(c)) != s_types.get(c)}
    if diff:
        res["type_diff"] = diff
    ok_cols = sorted(s_cols) == sorted(o_cols)
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    ok_vals = a == b
    res["status"] = "match" if (ok_cols and ok_vals and len(a) == len(b)) else "MISMATCH"
    if not ok_vals:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    return res
