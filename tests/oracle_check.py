"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, repr(round(value, 9)))
    return (2, repr(float(value))) if type(value).__name__ == "Decimal" else (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want, got = rows_of(names, cur.fetchall()), rows_of(df.columns, df.collect())
    kinds = {c[0]: str(c[1]) for c in cur.description}
    if want == got:
        odd = [(n, t, kinds[n]) for n, t in df.dtypes if "HUGEINT" in kinds[n] or "DECIMAL" in kinds[n]]
        return f"types {odd}" if odd else ""
    missing, extra = sorted(set(want) - set(got))[:2], sorted(set(got) - set(want))[:2]
    return f"{len(got)} rows vs {len(want)}; only sql {missing}; only spark {extra}"


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from roomtide.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = query(spark, sf)
            result = compare(df, con, sqls[name]) if name in sqls else f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(result)
        print(f"{name:32} {time.time() - t0:6.2f}s {result[:1800] or 'ok'}", flush=True)
    print("not ok:", bad)
