"""Run registered queries against their SQL checks in DuckDB and compare every value."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(df[c]) or pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("int64")
        elif pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64") + 0.0
        else:
            df[c] = df[c].astype(object).where(df[c].notna(), None)
    return df.sort_values(list(df.columns), na_position="first", ignore_index=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for c in a.columns:
        if a[c].dtype != b[c].dtype:
            return f"{c}: {a[c].dtype} vs {b[c].dtype}"
        bad = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if bad.any():
            i = bad.idxmax()
            return f"{c}: {bad.sum()} rows differ, first {a[c][i]!r} vs {b[c][i]!r}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from thermolens.session import get_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("--checked", action="store_true", help="only queries that have a SQL check")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, failed = connect(args.folder), oracle_sql(), 0
    for name, run in queries().items():
        if (args.names and name not in args.names) or (args.checked and name not in checks):
            continue
        start = time.perf_counter()
        try:
            ours = run(spark, args.folder).toPandas()
            seconds = time.perf_counter() - start
            problem = None
            if name in checks:
                problem = differences(ours, con.execute(checks[name]).df())
            state = "rows only" if name not in checks else problem or "equal"
        except Exception as error:  # noqa: BLE001
            seconds, ours, problem = time.perf_counter() - start, [], error
            state = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {len(ours):7d} rows {seconds:7.2f} s  {state}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
