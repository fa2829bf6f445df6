"""Run registered queries next to their SQL and compare all rows.

    python -m checks.compare [--sf /root/testdata/sf0.01] [query ...]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLES
from checks.queries import QUERIES

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when schema and rows agree, else what differs."""
    columns = sorted(df.columns)
    if len(set(columns)) != len(columns):
        return f"repeated columns {columns}"
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        return f"schema {ours} != {theirs}"
    order = [d[0] for d in result.description]
    want = Counter(
        tuple(plain(dict(zip(order, row))[c]) for c in columns) for row in result.fetchall()
    )
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    if got != want:
        extra, missing = got - want, want - got
        show = lambda c: [str(r)[:600] for r in list(c)[:2]]
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"{sum(extra.values())} extra {show(extra)}; {sum(missing.values())} missing {show(missing)}"
        )
    return ""


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("queries", nargs="*")
    given = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(given.sf)
    bad = 0
    for name in given.queries or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, given.sf)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        print(f"{time.time() - start:6.2f}s  {name:32s} {problem or 'ok'}", flush=True)
    print(f"{bad} differ", flush=True)


if __name__ == "__main__":
    main()
