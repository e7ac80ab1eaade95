"""Run registered Spark queries against their DuckDB oracle SQL.

    python tests/oracle_check.py [sf_dir] [query ...]

Prints one line per query: rows, schema match, exact value match and value
match at 9 significant digits.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v, sig: int | None):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):  # DuckDB's decimal literals and wide integers
        v = int(v) if v == v.to_integral_value() and v.as_tuple().exponent >= 0 else float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if sig is None or v == 0 or math.isinf(v):
            return repr(v + 0.0)
        return f"{v:.{sig}g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ in ("date", "Timestamp", "datetime") else v.isoformat()
    if isinstance(v, (bool,)):
        return bool(v)
    if hasattr(v, "item"):
        return _norm_value(v.item(), sig)
    return v


def normalise(df: pd.DataFrame, sig: int | None) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple("\x00NULL" if (x := _norm_value(v, sig)) is None else x for v in rec))
    rows.sort(key=lambda r: tuple(str(x) for x in r))
    return rows


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_pd = sdf.toArrow().to_pandas(integer_object_nulls=True)
    ts = time.time() - t0
    t0 = time.time()
    d_pd = con.sql(sql).to_arrow_table().to_pandas(integer_object_nulls=True) if sql else None
    td = time.time() - t0
    out = {"query": name, "spark_rows": len(s_pd), "spark_s": round(ts, 1)}
    if d_pd is None:
        out["oracle"] = "none"
        return out
    # timestamps from duckdb DATE come back as datetime64 -> compare as dates
    for c in d_pd.columns:
        if str(d_pd[c].dtype).startswith("datetime64"):
            d_pd[c] = d_pd[c].dt.date
    out.update(duck_rows=len(d_pd), duck_s=round(td, 1),
               cols=sorted(s_pd.columns) == sorted(d_pd.columns))
    if out["cols"]:
        a, b = normalise(s_pd, None), normalise(d_pd, None)
        out["exact"] = a == b
        if not out["exact"]:
            a9, b9 = normalise(s_pd, 9), normalise(d_pd, 9)
            out["sig9"] = a9 == b9
            diff = [(x, y) for x, y in zip(a9, b9) if x != y][:3]
            out["diff"] = diff
    else:
        out["spark_cols"] = sorted(s_pd.columns)
        out["duck_cols"] = sorted(d_pd.columns)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    import __spark_entry__ as entry
    from hubcast.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            print(compare(spark, con, name, fn, sqls.get(name), sf_dir), flush=True)
        except Exception as e:  # report and continue
            print({"query": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}, flush=True)


if __name__ == "__main__":
    main(sys.argv)
