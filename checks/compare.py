"""Run the registered queries next to their SQL in DuckDB and compare the values.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def compare(spark, con, folder: str, name: str, queries=QUERIES, oracles=ORACLES) -> tuple[str, float, float]:
    started = time.time()
    df = queries[name](spark, folder)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - started
    if name not in oracles:
        return f"rows only ({sum(mine.values())})", spent, 0.0
    started = time.time()
    result = con.execute(oracles[name])
    result_types = result.description
    columns = [d[0] for d in result.description]
    theirs = rows(columns, result.fetchall())
    sql_time = time.time() - started
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS differ: {sorted(df.columns)} / {sorted(columns)}", spent, sql_time
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    types = {d[0]: str(d[1]) for d in result_types}
    odd = {c: (t, types[c]) for c, t in df.dtypes if kinds.get(t) != types[c]}
    if odd:
        return f"TYPES differ: {odd}", spent, sql_time
    if mine != theirs:
        extra, lacking = mine - theirs, theirs - mine
        examples = [str(x)[:600] for x in (*list(extra)[:2], "---", *list(lacking)[:2])]
        return "DIFFERS: " + "\n    ".join([f"{sum(extra.values())} / {sum(lacking.values())}", *examples]), spent, sql_time
    return f"ok ({sum(mine.values())} rows)", spent, sql_time


def main() -> None:
    from gleanery.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare", cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    for name in sys.argv[2:] or QUERIES:
        try:
            verdict, spent, sql_time = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            verdict, spent, sql_time = f"ERROR {type(e).__name__}: {str(e)[:800]}", 0.0, 0.0
        print(f"{name:22} {spent:6.1f}s {sql_time:6.1f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
