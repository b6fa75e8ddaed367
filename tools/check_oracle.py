"""Run Spark queries and their DuckDB oracle side by side and compare results.

Usage: python tools/check_oracle.py [--sf-dir DIR] [key ...]
With ``--roles`` it compares every role table instead of the registered queries.
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from voltcube.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if hasattr(v, "item"):
        return norm_value(v.item())
    return v


def norm_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_value(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def compare(name, spark_df, con, sql):
    t0 = time.time()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = norm_rows(s_cols, s_rows)
    dc, dr = norm_rows(d_cols, d_rows)
    ok = sc == dc and sr == dr
    msg = f"{'OK ' if ok else 'BAD'} {name}: spark {len(sr)} rows, oracle {len(dr)} rows ({t1 - t0:.1f}s)"
    if sc != dc:
        msg += f"\n   cols spark={sc}\n   cols duck ={dc}"
    elif sr != dr:
        a, b = set(sr), set(dr)
        msg += f"\n   only spark: {sorted(a - b, key=str)[:3]}\n   only duck : {sorted(b - a, key=str)[:3]}"
    print(msg, flush=True)
    return ok


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--roles", action="store_true")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    from voltcube.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(a.sf_dir)
    bad = []
    if a.roles:
        from voltcube.plans.oracle_roles import with_roles
        from voltcube.plans.roles import Roles
        roles = Roles(spark, a.sf_dir)
        names = a.keys or ["country_dim", "year_dim", "ev_market", "ev_infrastructure", "country_energy",
                           "country_macro", "dirty_name", "raw_ev", "energy_primary", "raw_generation",
                           "raw_macro", "raw_co2", "run_timing"]
        for n in names:
            df = getattr(roles, n)
            if n == "raw_ev":
                sql = with_roles("select region, category, parameter, mode, powertrain, year, value from raw_ev")
                df = df.drop("dup")
            else:
                sql = with_roles(f"select * from {n}")
            if not compare(n, df, con, sql):
                bad.append(n)
    else:
        import importlib.util
        spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        qs, sqls = entry.queries(), entry.oracle_sql()
        for k in (a.keys or list(qs)):
            try:
                df = qs[k](spark, a.sf_dir)
                if k not in sqls:
                    n = df.count()
                    print(f"--  {k}: {n} rows (no oracle)")
                    continue
                sql = sqls[k]
                if not compare(k, df, con, sql):
                    bad.append(k)
            except Exception as e:  # report and continue
                print(f"ERR {k}: {type(e).__name__}: {str(e)[:400]}")
                bad.append(k)
    print("FAILED:", bad if bad else "none")
    spark.stop()


if __name__ == "__main__":
    main()
