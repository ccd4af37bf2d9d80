"""Oracle comparison: run a registered Spark query and its DuckDB SQL on the same
parquet tables and compare row count, column names and values (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
    except ImportError:
        pass
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return [cols[i] for i in order], out


def _spark_type_names(sdf) -> dict:
    from pyspark.sql import types as T
    names = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
             T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.BooleanType: "BOOLEAN", T.FloatType: "FLOAT",
             T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.ShortType: "SMALLINT", T.ByteType: "TINYINT"}

    def name(t) -> str:
        return f"{name(t.elementType)}[]" if isinstance(t, T.ArrayType) else names.get(type(t), str(t))
    return {f.name: name(f.dataType) for f in sdf.schema.fields}


def compare(spark, name: str, sf_dir: str, fn, sql: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = _spark_type_names(sdf)
    s_recs = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_cols = list(rel.columns)
    d_recs = rel.fetchall()
    sc, sr = _rows(s_cols, s_recs)
    dc, dr = _rows(d_cols, d_recs)
    res = {"name": name, "spark_rows": len(sr), "duck_rows": len(dr), "cols_match": sc == dc,
           "spark_cols": sc, "duck_cols": dc}
    res["types_match"] = s_types == d_types
    if not res["types_match"]:
        res["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    exact = sc == dc and sr == dr
    res["exact"] = exact
    if not exact and len(sr) == len(dr) and sc == dc:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        res["n_diff"] = len(bad)
        res["example"] = bad[:3]
    return res
