"""Run a query on Spark and its SQL on DuckDB and compare them as bags of rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return (str(value), "decimal")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def duck_types(relation) -> dict[str, str]:
    names = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
             "BOOLEAN": "boolean"}
    return {c: names.get(str(t), str(t).lower()) for c, t in zip(relation.columns, relation.types)}


def differences(df, con, sql: str) -> list[str]:
    """What is not the same, in words; empty when all is."""
    relation = con.sql(sql)
    found = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} against {sorted(relation.columns)}"]
    spark_types, sql_types = dict(df.dtypes), duck_types(relation)
    found += [
        f"type of {c}: {spark_types[c]} against {sql_types[c]}"
        for c in df.columns
        if spark_types[c] != sql_types[c]
    ]
    ours = bag(df.columns, df.collect())
    theirs = bag(relation.columns, relation.fetchall())
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())};"
            f" only ours {list((ours - theirs).items())[:3]};"
            f" only theirs {list((theirs - ours).items())[:3]}"
        )
    return found
