"""Run every query against its oracle: ``python -m acceptance.check [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from acceptance.oracles import all_oracles
from acceptance.queries import all_queries
from gridmarts.session import local_session


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def sorted_rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(by=list(frame.columns), na_position="last").reset_index(drop=True)


def differences(spark_table, duck_table) -> list[str]:
    """Problems found between two Arrow tables, compared without regard to order."""
    ours = dict(zip(spark_table.column_names, spark_table.schema.types))
    theirs = dict(zip(duck_table.column_names, duck_table.schema.types))
    if ours != theirs:
        odd = {n: (ours.get(n), theirs.get(n)) for n in {*ours, *theirs} if ours.get(n) != theirs.get(n)}
        return [f"schema: {odd}"]
    if spark_table.num_rows != duck_table.num_rows:
        return [f"rows: {spark_table.num_rows} and {duck_table.num_rows}"]
    a, b = sorted_rows(spark_table.to_pandas()), sorted_rows(duck_table.to_pandas())
    bad = []
    for name in a.columns:
        same = (a[name] == b[name]) | (a[name].isna() & b[name].isna())
        if not same.all():
            at = same.idxmin()
            bad.append(f"{name}: {(~same).sum()} differ, first {a[name][at]!r} and {b[name][at]!r}")
    return bad


def compare(spark, con, name: str, sf_dir: str) -> tuple[list[str], int, float]:
    began = time.time()
    ours = all_queries()[name](spark, sf_dir).toArrow()
    took = time.time() - began
    theirs = con.sql(all_oracles()[name]).to_arrow_table()
    return differences(ours, theirs), ours.num_rows, took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), duckdb_views(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in sys.argv[2:] or all_queries():
        try:
            bad, rows, took = compare(spark, con, name, sf_dir)
        except Exception as error:  # a broken query must not hide the others
            bad, rows, took = [f"{type(error).__name__}: {str(error)[:600]}"], 0, 0.0
        failed += bool(bad)
        print(f"{'ok  ' if not bad else 'FAIL'} {name:26} {rows:8} rows {took:6.2f} s", *bad[:4], flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
