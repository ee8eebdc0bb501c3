"""Run registered Spark queries and their DuckDB twins side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names (sorted) and an order-insensitive value hash.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    h = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, bad_nodes: list[str] = ()) -> dict[str, dict]:
    """Per query: rows, match, time, error, and which of ``bad_nodes`` its plan has."""
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    con.execute("SET memory_limit='4GB'")
    con.execute("SET threads=4")
    out = {}
    for name in names or list(qs):
        rec: dict = {}
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
            rec["plan"] = [n for n in bad_nodes if n in plan]
            rows = [tuple(r) for r in df.collect()]
            s = digest(df.columns, rows)
            rec["spark_rows"], rec["spark_sec"] = s[0], round(time.time() - t, 2)
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"spark: {type(e).__name__}: {str(e)[:400]}"
            out[name] = rec
            print(name, json.dumps(rec), flush=True)
            continue
        if name in sqls:
            try:
                cur = con.execute(sqls[name])
                cols = [d[0] for d in cur.description]
                o = digest(cols, cur.fetchall())
                rec["oracle_rows"] = o[0]
                rec["match"] = s == o
                if s[1] != o[1]:
                    rec["cols"] = [s[1], o[1]]
            except Exception as e:  # noqa: BLE001
                rec["error"] = f"duckdb: {type(e).__name__}: {str(e)[:400]}"
        out[name] = rec
        print(name, json.dumps(rec), flush=True)
    return out


if __name__ == "__main__":
    from hitlist.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v.get("match")]
    print("MISMATCH/ERROR:", bad)
