"""Running a registered query in Spark and its oracle in DuckDB, and comparing the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{Path(directory) / name}.parquet')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def spark_rows(frame: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    return names, sorted((tuple(r) for r in frame.select(*names).collect()), key=_sortable)


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=_sortable)


def duckdb_types(con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    described = con.execute(f"describe {sql}").fetchall()
    return {row[0]: row[1] for row in described}


# Spark type -> the DuckDB type a result column should have.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
