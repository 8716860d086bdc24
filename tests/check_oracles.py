"""Run registered queries next to their SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connection(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v + 0.0, 8))
    if isinstance(v, int):
        return str(v)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, name, query, sql):
    start = time.time()
    df = query(spark, sf)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return f"rows {len(ours)}", seconds
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = canonical(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} / {sorted(columns)}", seconds
    if ours == theirs:
        return f"ok {len(ours)}", seconds
    only = [r for r in zip(ours, theirs) if r[0] != r[1]][:3]
    return f"MISMATCH rows {len(ours)} / {len(theirs)}: {only}", seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lumenfit.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connection(sf)
    spark.sparkContext.setLogLevel("OFF")
    oracles, wanted = entry.oracle_sql(), sys.argv[2:]
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            outcome, seconds = compare(spark, con, sf, name, query, oracles.get(name))
        except Exception as problem:  # report and go on with the next query
            outcome, seconds = f"ERROR {type(problem).__name__} {str(problem)[:600]}", 0.0
        print(f"{name:28s} {seconds:6.2f}s  {outcome}", flush=True)
