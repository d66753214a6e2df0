"""Run queries and their SQL side by side: ``python -m verification.compare DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from glob import glob
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


def _sort_key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def _normal(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns in name order and rows in value order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(_normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(ordered, key=_sort_key)


def difference(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, folder: str
) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = QUERIES[name](spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(ORACLE[name])
    theirs = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    different = [(a, b) for a, b in zip(ours[1], theirs[1], strict=True) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in names:
        start = time.time()
        found = difference(spark, connection, name, folder)
        print(f"{name}: {found or 'equal'} ({time.time() - start:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
