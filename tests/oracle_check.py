"""Compare registered queries with their SQL counterparts run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

RAW = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
       "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def _same_type(spark_type: str, duck_type: str) -> bool:
    wanted = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
    return wanted.get(spark_type) == duck_type


def compare(spark, con, folder, build, sql) -> dict:
    """Row and type differences between the two sides; empty when they agree."""
    began = time.time()
    df = build(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - began
    cursor = con.execute(sql)
    names, kinds = [c[0] for c in cursor.description], [str(c[1]) for c in cursor.description]
    want = cursor.fetchall()
    problems = {}
    if sorted(df.columns) != sorted(names):
        problems["columns"] = (sorted(df.columns), sorted(names))
    else:
        spark_kinds = dict(df.dtypes)
        odd = {n: (spark_kinds[n], k) for n, k in zip(names, kinds) if not _same_type(spark_kinds[n], k)}
        if odd:
            problems["types"] = odd
        a, b = _sorted_rows(df.columns, got), _sorted_rows(names, want)
        if len(a) != len(b):
            problems["rows"] = (len(a), len(b))
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            problems["values"] = (len(diff), diff[:2])
    return {"problems": problems, "rows": len(got), "seconds": round(took, 2)}


if __name__ == "__main__":
    import sys

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as e
    from convivio.session import build_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    session = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(folder), e.oracle_sql()
    bad = 0
    for name, build in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            if name in sqls:
                out = compare(session, con, folder, build, sqls[name])
            else:
                out = {"problems": {}, "rows": build(session, folder).count(), "seconds": None, "note": "rows only"}
        except Exception as err:
            out = {"problems": {"error": str(err)[:700]}}
        bad += bool(out["problems"])
        print("BAD" if out["problems"] else "ok ", name, {k: v for k, v in out.items() if k != "problems" or v}, flush=True)
    print("bad:", bad, "missing oracle:", sorted(set(e.queries()) - set(sqls)), "extra:", sorted(set(sqls) - set(e.queries())))
