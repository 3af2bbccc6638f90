"""Run registered queries next to their SQL and compare the rows. ``python tests/check.py [sf_dir] [name ...]``"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

VERBOSE = bool(os.environ.get("CHECK_TYPES"))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    sql_types = {d[0]: str(d[1]).lower() for d in cur.description}
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    names = {"varchar": "string", "integer": "int"}
    types = {n: (t, names.get(sql_types[n], sql_types[n])) for n, t in df.dtypes if n in sql_types}
    odd = {n: t for n, t in types.items() if t[0] != t[1]}
    if odd and VERBOSE:
        print("     types", name, odd)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        extra, missing = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows != {len(want)}; extra {list(extra)[:2]} missing {list(missing)[:2]}"
    if not got:
        return "no rows"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries
    from marquee.session import builder

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    plain = SparkSession.builder if os.environ.get("CHECK_PLAIN") else builder("check").config("spark.sql.shuffle.partitions", "8")
    spark = plain.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries()[name], oracle_sql().get(name), sf_dir)
        except Exception as e:
            where = [f for f in traceback.extract_tb(e.__traceback__) if "/marquee/" in f.filename]
            at = f"{where[-1].filename.split('/')[-1]}:{where[-1].lineno}" if where else ""
            problem = f"{at} {type(e).__name__} {str(e)[:500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
