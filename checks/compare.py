"""Compare registered queries with their SQL: python -m checks.compare SF_DIR [query ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import oracle_sql
from checks.queries import queries
from checks.session import local_session

TABLES = ("customer", "orders", "lineitem", "events")


def _comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if str(df[name].dtype).startswith("datetime"):
            df[name] = df[name].astype("datetime64[us]").astype(str)
        elif df[name].dtype.kind in "iuf":
            df[name] = df[name].astype("float64")
        else:
            missing = df[name].isna()
            df[name] = df[name].astype(str).where(~missing, "")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark, connection, name: str, sf_dir: str) -> tuple[str, int, float]:
    """What differs ('' for nothing), the number of rows, and the Spark query's seconds."""
    started = time.time()
    ours = queries()[name](spark, sf_dir).toPandas()
    seconds = time.time() - started
    theirs = connection.sql(oracle_sql()[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}", len(ours), seconds
    if len(ours) != len(theirs):
        return f"rows {len(ours)} and {len(theirs)}", len(ours), seconds
    # A whole number with gaps is float64 from one engine and Int64 from the other.
    number = {kind: "number" for kind in "iuf"}
    kinds = [
        c
        for c in ours.columns
        if number.get(ours[c].dtype.kind, ours[c].dtype.kind) != number.get(theirs[c].dtype.kind, theirs[c].dtype.kind)
    ]
    left, right = _comparable(ours), _comparable(theirs)
    wrong = [c for c in left.columns if not left[c].equals(right[c])]
    report = f"values {wrong}" if wrong else ""
    if kinds:
        report += " types " + ", ".join(f"{c} {ours[c].dtype} {theirs[c].dtype}" for c in kinds)
    return report, len(ours), seconds


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    spark, connection = local_session(), connect(sf_dir)
    for name in names or queries():
        report, rows, seconds = difference(spark, connection, name, sf_dir)
        print(f"{'DIFF' if report else 'same'} {name} {rows} rows {seconds:.2f} s {report}", flush=True)
