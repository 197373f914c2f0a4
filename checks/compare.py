"""Run queries and their oracles side by side: python -m checks.compare [sf_dir] [names...]."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLES
from checks.queries import QUERIES


def session(cores: int | str = 8) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName("billflow")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false").getOrCreate())


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.9g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def normal_rows(columns, rows) -> tuple[list, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, con, sf_dir, name) -> str:
    df = QUERIES[name](spark, sf_dir)
    mine = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return f"rows only ({len(mine[1])})"
    cursor = con.execute(ORACLES[name])
    theirs = normal_rows([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"COLUMNS {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"ROWS {len(mine[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"VALUES {len(wrong)} differ: {wrong[:2]}" if wrong else f"ok ({len(mine[1])})"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            told = compare(spark, con, sf_dir, name)
        except Exception as problem:
            told = f"FAILED {type(problem).__name__}: {str(problem)[:700]}"
        bad += not told.startswith(("ok", "rows only"))
        print(f"{name:32s} {time.time() - start:6.1f}s {told}", flush=True)
    print(f"{len(names)} queries, {bad} bad; without oracle: "
          f"{[n for n in QUERIES if n not in ORACLES]}; stray oracles: "
          f"{[n for n in ORACLES if n not in QUERIES]}")


if __name__ == "__main__":
    main()
