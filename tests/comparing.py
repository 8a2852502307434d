"""Compare a registered query with its DuckDB statement, value by value."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

import __spark_entry__ as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if glob.glob(path):
            con.execute(f"create view {table} as select * from '{path}'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(map(_plain, row)) for row in frame[columns].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between the two engines; empty when they agree exactly."""
    mine = registered.queries()[name](spark, sf_dir)
    theirs = con.execute(registered.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in theirs.description}
    spark_kinds = dict(mine.dtypes)
    if set(kinds) != set(spark_kinds):
        return [f"columns {sorted(spark_kinds)} != {sorted(kinds)}"]
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    found = [f"{c}: {spark_kinds[c]} != {kinds[c]}" for c in kinds if names[spark_kinds[c]] != kinds[c]]
    left = rows_of(pd.DataFrame([tuple(r) for r in mine.collect()], columns=mine.columns, dtype=object))
    right = rows_of(pd.DataFrame(theirs.fetchall(), columns=list(kinds), dtype=object))
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
