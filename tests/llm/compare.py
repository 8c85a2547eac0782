"""Runs registered queries beside their check SQL: python tests/llm/compare.py SF_DIR NAME..."""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def expected(sql: str, folder: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    return con.sql(sql).df()


def same(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty if both hold the same rows, else what differs."""
    cols = sorted(got.columns)
    if cols != sorted(want.columns):
        return f"columns {cols} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    try:
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-12)
    except AssertionError as e:
        return str(e)[:800]
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark = local_session(8, "compare", tempfile.mkdtemp(prefix="compare-"))
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        began = time.perf_counter()
        got = entry.queries()[name](spark, sys.argv[1]).toPandas()
        took, sql = time.perf_counter() - began, entry.oracle_sql().get(name)
        print(name, len(got), f"{took:.1f} s", (same(got, expected(sql, sys.argv[1])) or "same") if sql else got.head(8).to_string())
    spark.stop()
