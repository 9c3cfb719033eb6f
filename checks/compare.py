"""Run queries in Spark and DuckDB side by side: ``python -m checks.compare [sf] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from aforo.session import build_session
from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if hasattr(v, "isoformat"):
            return v.isoformat()[:10]
        if isinstance(v, bool):
            return str(v)
        return f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def compare(name: str, spark, con, sf_dir: str) -> str:
    """Empty when equal, else the first difference."""
    mine = QUERIES[name](spark, sf_dir)
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    theirs = pd.DataFrame(cursor.fetchall(), columns=columns, dtype=object)
    if sorted(mine.columns) != sorted(columns):
        return f"columns {sorted(set(mine.columns) ^ set(columns))}"
    got = pd.DataFrame([tuple(r) for r in mine.collect()], columns=mine.columns, dtype=object)
    left, right = rows_of(got), rows_of(theirs)
    if left == right:
        return ""
    extra = next((r for r in left if r not in set(right)), None)
    missing = next((r for r in right if r not in set(left)), None)
    return f"rows {len(left)}/{len(right)}\n  spark only {extra}\n  duckdb only {missing}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            problem = compare(name, spark, con, sf_dir) if name in ORACLES else f"no oracle, {QUERIES[name](spark, sf_dir).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - began:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
