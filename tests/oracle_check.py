"""Run registered queries in Spark and their oracle SQL in DuckDB on the
same Parquet tables and compare row count, column names and an
order-insensitive value hash (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h


def _spark_type(t: str) -> str:
    t = t.lower()
    if t.startswith("array<"):
        return _spark_type(t[6:-1]) + "[]"
    return {"tinyint": "int32", "smallint": "int32", "int": "int32", "bigint": "int64",
            "float": "float", "double": "float", "string": "string"}.get(
        t, "decimal" if t.startswith("decimal") else t)


def _duck_type(t) -> str:
    t = str(t).upper()
    if t.endswith("[]"):
        return _duck_type(t[:-2]) + "[]"
    return {"TINYINT": "int32", "SMALLINT": "int32", "INTEGER": "int32", "BIGINT": "int64",
            "HUGEINT": "int128", "FLOAT": "float", "DOUBLE": "float", "VARCHAR": "string"}.get(
        t, "decimal" if t.startswith("DECIMAL") else t.lower())


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    scols, sn, sh = digest(sdf.columns, srows)
    out = {"query": name, "rows": sn, "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.sql(sql)
    dcols = list(res.columns)
    dtypes = {c: _duck_type(t) for c, t in zip(dcols, res.types)}
    drows = res.fetchall()
    dcols, dn, dh = digest(dcols, drows)
    stypes = {c: _spark_type(t) for c, t in sdf.dtypes}
    types_ok = stypes == dtypes
    out.update(oracle_rows=dn, cols_match=scols == dcols, types_match=types_ok, hash_match=sh == dh)
    if not types_ok:
        out["type_diffs"] = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
                             if stypes.get(c) != dtypes.get(c)}
    out["status"] = "ok" if (sn == dn and scols == dcols and sh == dh and types_ok) else "MISMATCH"
    if scols != dcols:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from boutique.session import build_session
    import __spark_entry__ as entry
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    results = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"query": name, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:400]}"}
        print(json.dumps(r), flush=True)
        results.append(r)
    bad = [r["query"] for r in results if r["status"] in ("MISMATCH", "ERROR")]
    print(json.dumps({"total": len(results), "bad": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
