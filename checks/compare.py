"""Compare registered queries with their DuckDB SQL.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession


def session(cpus: str = "8") -> SparkSession:
    from riskloom.session import RECOMMENDED

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("checks")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def differences(spark: SparkSession, con, query, sql: str, sf_dir: str) -> tuple[int, list]:
    """Number of rows of the Spark result and what differs from DuckDB's."""
    ours = query(spark, sf_dir)
    theirs = con.execute(sql)
    names = [c[0] for c in theirs.description]
    problems = []
    if sorted(names) != sorted(ours.columns):
        return 0, [("columns", sorted(ours.columns), sorted(names))]
    order = sorted(names)
    ours_rows = Counter(tuple(r[c] for c in order) for r in ours.collect())
    at = [names.index(c) for c in order]
    their_rows = Counter(tuple(r[i] for i in at) for r in theirs.fetchall())
    problems += [("only spark", order, r) for r in (ours_rows - their_rows)]
    problems += [("only duckdb", order, r) for r in (their_rows - ours_rows)]
    return sum(ours_rows.values()), problems


def main(argv: list[str]) -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    sf_dir, wanted = argv[0], argv[1:] or list(QUERIES)
    spark, con, bad = session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in wanted:
        start = time.time()
        try:
            n, problems = differences(spark, con, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            n, problems = 0, [(type(e).__name__, str(e)[:1500])]
        bad += bool(problems)
        print(f"{name:26s} {n:8d} rows {time.time() - start:6.2f}s {'OK' if not problems else f'{len(problems)} DIFFER'}", flush=True)
        for p in problems[:2]:
            print("   ", p)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
