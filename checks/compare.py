"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(spark, con, name: str, run, oracle: str | None, sf_dir: str) -> str:
    start = time.time()
    df = run(spark, sf_dir)
    names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if oracle is None:
        return f"rows  {name}: {len(got)} rows, {took:.1f}s"
    start = time.time()
    cur = con.execute(oracle)
    want_names, want = canonical([d[0] for d in cur.description], cur.fetchall())
    sql_took = time.time() - start
    if names != want_names:
        return f"FAIL  {name}: columns {names} != {want_names}"
    if got != want:
        missing = sorted(set(want) - set(got))[:3]
        extra = sorted(set(got) - set(want))[:3]
        return f"FAIL  {name}: {len(got)} vs {len(want)} rows\n   only sql: {missing}\n   only spark: {extra}"[:1500]
    return f"ok    {name}: {len(got)} rows, {took:.1f}s (sql {sql_took:.1f}s)"


def main() -> None:
    from pyspark.sql import SparkSession

    from .catalog import ORACLES, QUERIES

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="termloom-checks-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    for name, run in QUERIES.items():
        if args[1:] and name not in args[1:]:
            continue
        try:
            print(compare(spark, con, name, run, ORACLES.get(name), sf_dir), flush=True)
        except Exception as e:  # report and go on with the next query
            print(f"ERROR {name}: {str(e)[:700]}", flush=True)


if __name__ == "__main__":
    main()
