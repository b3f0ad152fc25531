"""Compare a Spark query with its DuckDB oracle on the same Parquet tables.

Used by the tests and by hand while developing. The Spark result is brought
to the driver here only because this is a test harness on small fixtures.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_frame(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetch_df()


def _norm(v, exact=False):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if exact:
            return v
        return round(v, 6) if abs(v) < 1e15 else v
    if hasattr(v, "item"):
        return _norm(v.item(), exact)
    if isinstance(v, _dt.datetime):
        return v.date() if v.time() == _dt.time(0) else v
    try:
        import pandas as pd
        if v is pd.NaT or (isinstance(v, type(pd.NA)) ):
            return None
        if isinstance(v, pd.Timestamp):
            return _norm(v.to_pydatetime(), exact)
    except Exception:  # pragma: no cover
        pass
    return v


def compare(spark: SparkSession, df, sql: str, sf_dir: str, exact: bool = False) -> dict:
    """Row count, column names and sorted values of a Spark DataFrame vs SQL."""
    rows = [r.asDict() for r in df.collect()]
    pdf = duckdb_frame(sql, sf_dir)
    s_cols = sorted(df.columns)
    d_cols = sorted(pdf.columns)
    out = {"spark_rows": len(rows), "oracle_rows": len(pdf), "columns_match": s_cols == d_cols,
           "spark_cols": s_cols, "oracle_cols": d_cols}
    if s_cols != d_cols:
        out["match"] = False
        return out
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    norm = (lambda v: _norm(v, True)) if exact else _norm
    s_vals = sorted((tuple(norm(r[c]) for c in s_cols) for r in rows), key=key)
    d_vals = sorted((tuple(norm(_py(v)) for v in rec) for rec in
                     pdf[s_cols].itertuples(index=False, name=None)), key=key)
    diffs = [(a, b) for a, b in zip(s_vals, d_vals) if a != b]
    out["value_diffs"] = len(diffs) + abs(len(s_vals) - len(d_vals))
    out["first_diffs"] = diffs[:3]
    out["match"] = out["value_diffs"] == 0 and len(rows) == len(pdf)
    return out


def _py(v):
    try:
        import pandas as pd
        if v is None or v is pd.NaT or v is pd.NA:
            return None
        if isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime()
    except Exception:  # pragma: no cover
        pass
    if hasattr(v, "item"):
        return v.item()
    return v


def main(argv=None) -> int:
    """``python -m blendwise.plans.checks [--sf DIR] [names ...]``: compare queries."""
    import argparse
    import time

    from blendwise.plans import registry
    from blendwise.session import local_session

    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("--exact", action="store_true", help="compare doubles without rounding")
    p.add_argument("names", nargs="*")
    a = p.parse_args(argv)
    spark = local_session()
    qs, sqls = registry.queries(), registry.oracle_sql()
    names = a.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, a.sf)
            if n in sqls:
                r = compare(spark, df, sqls[n], a.sf, exact=a.exact)
            else:
                r = {"match": None, "spark_rows": df.count()}
        except Exception as e:  # report and continue
            r = {"match": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("match")
        bad += ok is False
        print(f"{'OK ' if ok else ('-- ' if ok is None else 'BAD')} {n:32s} {time.time()-t0:6.1f}s "
              f"{ {k: v for k, v in r.items() if k not in ('spark_cols', 'oracle_cols') or not r.get('columns_match', True)} }",
              flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
