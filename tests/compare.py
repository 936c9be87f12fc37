"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf] [name…]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tickloom.session import get_spark  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda x: None if x is None or x is pd.NA or x != x else (int(x) if isinstance(x, float) and x.is_integer() and abs(x) < 2**53 else x))
        df[c] = df[c].map(repr)
    return df.sort_values(list(df.columns), ignore_index=True)


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str:
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} against {sorted(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    a, b = normal(left), normal(right)
    unequal = (a != b).any(axis=1)
    if unequal.any():
        first = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ, first:\n  {a.loc[first].to_dict()}\n  {b.loc[first].to_dict()}"
    return ""


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{sf}"
    spark = get_spark(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            got = query(spark, folder).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"ROWS {name} {len(got)} {took:.1f}s", flush=True)
                continue
            wrong = differences(got, con.execute(sql[name]).df())
        except Exception as error:
            wrong, took = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start
        bad += bool(wrong)
        print(f"{'BAD' if wrong else 'ok '} {name} {took:.1f}s {wrong}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
