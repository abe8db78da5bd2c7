"""Runs registered queries next to their SQL twins in DuckDB and compares all rows.

As a script: ``python -m tests.oracle [data folder] [key …]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """One form for values both engines hold in different types."""
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 4) + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    found = _rows(df.columns, df.collect())
    if found == expected:
        return None
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"only here {list((found - expected).items())[:3]}; only in SQL {list((expected - found).items())[:3]}"
    )


def type_differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    }
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{f.name}: {f.dataType.simpleString()} / {described.get(f.name)}"
        for f in df.schema.fields
        if names.get(f.dataType.simpleString()) != described.get(f.name)
    ]


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from basketflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for key in keys:
        start = time.time()
        try:
            df = entry.queries()[key](spark, sf_dir)
            sql = entry.oracle_sql().get(key)
            if sql is None:
                outcome, types = f"rows only: {len(df.collect())}", []
            else:
                outcome, types = compare(df, con, sql), type_differences(df, con, sql)
        except Exception as error:  # noqa: BLE001
            outcome, types = f"{type(error).__name__}: {str(error)[:600]}", []
        bad += outcome is not None and not outcome.startswith("rows only")
        print(f"{time.time() - start:6.2f}s {key}: {outcome or 'ok'} {types or ''}", flush=True)
    print(f"{bad} of {len(keys)} differ")


if __name__ == "__main__":
    main()
