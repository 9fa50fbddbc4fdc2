"""Compare one Spark result with one DuckDB result: columns, row count, values in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, list):
        return tuple(map(_plain, value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())


# Spark type -> DuckDB type of the compared results
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def type_differences(df, con, sql: str) -> list[str]:
    duck = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    return [f"{f.name}: {f.dataType.simpleString()} / {duck.get(f.name)}" for f in df.schema
            if TYPES.get(f.dataType.simpleString()) != duck.get(f.name)]
