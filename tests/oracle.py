"""Compare registered queries with their SQL: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(**conf):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="callgrid-"))
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == int(v) and abs(v) < 2**53:
        return int(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def close(a, b) -> bool:
    """Equal, or, for doubles, within half of the last digit kept on both sides."""
    if a == b:
        return True
    return isinstance(a, (int, float)) and isinstance(b, (int, float)) and abs(a - b) <= 1e-9 * max(abs(a), abs(b))


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str:
    df = query(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return f"rows only: {len(got)}" if got else "EMPTY"
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in rel.description}
    odd = {c: k for c, k in kinds.items() if k in ("HUGEINT", "BOOLEAN", "DATE", "TIMESTAMP") or k.startswith("DECIMAL")}
    if odd:
        return f"TYPES {odd}"
    a, b = rows_of(df.columns, got), rows_of(columns, rel.fetchall())
    if len(a) != len(b):
        return f"ROWS spark={len(a)} sql={len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        note = "DIFFER" if not all(all(close(p, q) for p, q in zip(x, y)) for x, y in bad) else "ROUNDING"
        return f"{note} in {len(bad)} of {len(a)}: {sorted(columns)} {bad[0]}"
    return "EMPTY" if not a else f"ok {len(a)}"


def main(argv):
    sf_dir = argv[0] if argv and "/" in argv[0] else "/root/testdata/sf0.01"
    names = [a for a in argv if "/" not in a]
    import __spark_entry__ as e

    conf = dict(p.split("=", 1) for p in os.environ.get("ORACLE_CONF", "").split() if p)
    spark, con = session(**conf), duck(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name in queries:
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            result = compare(spark, con, sf_dir, name, queries[name], sqls.get(name))
        except Exception as x:  # report and go on
            result = f"ERROR {type(x).__name__}: {str(x)[:600]}"
        fine = result.startswith(("ok", "rows only"))
        bad += not fine
        print(f"{'  ' if fine else '!!'} {name} {result} {time.time() - start:.1f}s", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
