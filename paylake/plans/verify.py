"""Compare registered queries with their DuckDB oracle.

``python -m paylake.plans.verify /root/testdata/sf0.01 [name ...]`` prints one
line per query: rows, schema and value agreement.  Values are compared as an
order-insensitive multiset with columns sorted by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "ShortType": "SMALLINT", "ByteType": "TINYINT",
    "DoubleType": "DOUBLE", "FloatType": "FLOAT", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
    "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def spark_types(df) -> dict[str, str]:
    out = {}
    for f in df.schema.fields:
        n = type(f.dataType).__name__
        out[f.name] = _SPARK_TO_DUCK.get(n, f.dataType.simpleString().upper())
    return out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from paylake.plans.catalog import REGISTRY
    from paylake.plans.oracle import all_sql
    con = con or duck(sf_dir)
    t0 = time.time()
    df = REGISTRY[name](spark, sf_dir)
    s_rows = df.collect()
    t1 = time.time()
    s_cols = df.columns
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = all_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: str(c[1]) for c in cur.description}
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    st = spark_types(df)
    res["type_diff"] = {c: (st.get(c), d_types.get(c)) for c in set(st) | set(d_types)
                        if st.get(c) != d_types.get(c)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["sample_spark"] = diff_a
        res["sample_oracle"] = diff_b
    return res


def main(argv: list[str]) -> int:
    from paylake.session import build_session
    from paylake.plans.catalog import REGISTRY
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_match") and not r.get("type_diff") and r.get("cols_match")
        if r.get("oracle") == "none":
            ok = "error" not in r
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
