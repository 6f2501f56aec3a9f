"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return normal(columns, result.fetchall())


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def spark_types(df):
    return {name: KINDS.get(kind, kind) for name, kind in df.dtypes}


def duck_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
