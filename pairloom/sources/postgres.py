"""The collection in a PostgreSQL table, through Spark's JDBC source.

Connection settings come from the environment. Host, port and password have defaults;
the database and the user have to be named, by the environment or by the caller.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pairloom.schema import EXPORT_FIELDS

# Environment variables and their defaults.
DEFAULTS = {
    "POSTGRES_HOST": "localhost",
    "POSTGRES_PORT": "5432",
    "POSTGRES_DB": None,
    "POSTGRES_USER": None,
    "POSTGRES_PASSWORD": "",
}
# The stored name of a field whose own name is a reserved word in PostgreSQL.
STORED_NAMES = {"references": "references_"}

ROWS_PER_FETCH = 10_000


def connection_options(
    env: Mapping[str, str] | None = None,
    database: str | None = None,
    user: str | None = None,
) -> dict[str, str]:
    """JDBC options from the environment; a variable set to "" counts as set."""
    env = os.environ if env is None else env
    given = {"POSTGRES_DB": database, "POSTGRES_USER": user}
    values = {}
    for name, default in DEFAULTS.items():
        value = env.get(name, given.get(name) or default)
        if value is None:
            raise ValueError(f"{name} is not set and no value was given for it")
        values[name] = value
    host, port, db = (values[f"POSTGRES_{n}"] for n in ("HOST", "PORT", "DB"))
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{db}?sslmode=disable",
        "user": values["POSTGRES_USER"],
        "password": values["POSTGRES_PASSWORD"],
        "driver": "org.postgresql.Driver",
    }


def read_options(
    connection: Mapping[str, str], table: str, low: int, high: int, partitions: int
) -> dict[str, str]:
    """Options for a parallel read: the id range is cut into `partitions` queries."""
    if partitions <= 0:
        raise ValueError(f"partitions must be > 0, got {partitions}")
    return {
        **connection,
        "dbtable": table,
        "partitionColumn": "id",
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(ROWS_PER_FETCH),
    }


def id_bounds_options(connection: Mapping[str, str], table: str) -> dict[str, str]:
    """Options for the query that finds the id range, answered from the primary key."""
    if not re.fullmatch(r"\w+(\.\w+)?", table):
        raise ValueError(f"invalid table name: {table!r}")
    query = f"SELECT min(id) AS low, max(id) AS high FROM {table}"
    return {**connection, "query": query}


def stored_name(field: str) -> str:
    return STORED_NAMES.get(field, field)


def read_table(
    spark: SparkSession, table: str, partitions: int, connection: Mapping[str, str]
) -> DataFrame:
    """The table with its fields under their own names, read by `partitions` tasks."""
    bounds = spark.read.format("jdbc").options(**id_bounds_options(connection, table))
    low, high = bounds.load().first()
    options = read_options(connection, table, low or 0, high or 0, partitions)
    rows = spark.read.format("jdbc").options(**options).load()
    return from_table(rows)


def from_table(rows: DataFrame) -> DataFrame:
    for field, stored in STORED_NAMES.items():
        rows = rows.withColumnRenamed(stored, field)
    return rows.select("id", *EXPORT_FIELDS)


def to_table(pairs: DataFrame) -> DataFrame:
    """The columns to insert; the database gives `id` and `created_at` itself."""
    fields = [f for f in EXPORT_FIELDS if f != "created_at"]
    return pairs.select(*[pairs[f].alias(stored_name(f)) for f in fields])


def append_to_table(pairs: DataFrame, table: str, connection: Mapping[str, str]) -> None:
    """Append pairs whose keys are known to be new (see `operators.new_keys`)."""
    to_table(pairs).write.format("jdbc").options(**connection, dbtable=table).mode(
        "append"
    ).save()
