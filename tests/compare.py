"""Compares a Spark result with the rows of its SQL, regardless of row and column order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(con, text):
    result = con.execute(text)
    names = [column[0] for column in result.description]
    return sorted(names), _rows(names, result.fetchall())


# Spark type by DuckDB type.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def spark_types(df):
    return dict(df.dtypes)


def sql_types(con, text):
    result = con.execute(text)
    return {column[0]: TYPES.get(str(column[1]), str(column[1])) for column in result.description}
