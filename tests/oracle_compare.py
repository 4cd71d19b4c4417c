"""Run a registered query in Spark and its SQL twin in DuckDB and compare
(row count, column names, order-insensitive values with float tolerance)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return v


def _rows(df: pd.DataFrame, cols):
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    return sorted(out, key=key)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, tol: float = 0.0) -> str | None:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count differs: spark={len(spark_pdf)} duck={len(duck_pdf)}"
    a, b = _rows(spark_pdf, sc), _rows(duck_pdf, sc)
    bad = 0
    first = None
    for ra, rb in zip(a, b):
        for ca, va, vb in zip(sc, ra, rb):
            if va == vb:
                continue
            if isinstance(va, (int, float)) and isinstance(vb, (int, float)) and va is not None and vb is not None:
                if abs(va - vb) <= tol * max(1.0, abs(va), abs(vb)):
                    continue
            bad += 1
            if first is None:
                first = (ca, va, vb, ra, rb)
    if bad:
        return f"{bad} value mismatches; first: {first}"
    return None


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "boolean": "BOOLEAN", "date": "DATE"}


def type_diffs(spark_df, rel) -> list:
    st = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return [(c, st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt))
            if SPARK_TO_DUCK.get(st.get(c), st.get(c)) != dt.get(c)]


def run_pair(spark, name: str, sf_dir: str, queries: dict, oracle: dict, con=None):
    sdf_spark = queries[name](spark, sf_dir)
    sdf = sdf_spark.toPandas()
    if name not in oracle:
        return sdf, None, None
    con = con or duck(sf_dir)
    rel = con.sql(oracle[name])
    ddf = rel.df()
    err = compare(sdf, ddf)
    td = type_diffs(sdf_spark, rel)
    if err is None and td:
        err = f"column types differ: {td}"
    return sdf, ddf, err
