"""Compare every registered query with its SQL oracle: python -m tests.oracle_check [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return db


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    frame = frame.sort_values(list(frame.columns), kind="stable", na_position="first")
    return frame.reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    try:
        pd.testing.assert_frame_equal(normal(ours), normal(theirs), check_dtype=False)
    except AssertionError as error:
        return str(error)[:400]
    kinds = [(c, ours[c].dtype, theirs[c].dtype) for c in ours.columns
             if ours[c].dtype.kind != theirs[c].dtype.kind and ours[c].notna().all()]
    return f"types {kinds}" if kinds and len(ours) else None


def main(sf_dir: str, names: list[str]) -> int:
    from shoplens.session import build_session

    spark = build_session("oracle-check", master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            ours = query(spark, sf_dir).toPandas()
            took = time.time() - begin
            problem = difference(ours, db.sql(oracles[name]).df()) if name in oracles else None
        except Exception as error:  # report every query, then fail
            ours, took, problem = pd.DataFrame(), time.time() - begin, f"{type(error).__name__} {error}"[:1500]
        bad += problem is not None
        state = "BAD" if problem else ("ok" if name in oracles else "rows")
        print(f"{state:5}{name:32}{len(ours):9} rows {took:7.2f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
