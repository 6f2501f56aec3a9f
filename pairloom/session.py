"""Session settings the engine relies on, and its working folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pairloom.sources.folders import delete_folder

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Spark writes INT96 by default; dataset loaders expect microseconds in UTC.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A key given twice in one JSON object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the engine's settings on a session for good."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def engine_settings(spark: SparkSession) -> Iterator[None]:
    """Set them for the length of one job and put the caller's values back."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    configure(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def work_folder(spark: SparkSession, beside: str) -> Iterator[str]:
    """A fresh folder for the tables written between two steps of a job.

    It lies in the cluster's shared `spark.checkpoint.dir`; where that is unset, next to
    the data being written, which every executor reaches as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    prefix = f"{shared}/pairloom" if shared else f"{beside}/_work"
    folder = f"{prefix}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a work folder and continue from the files.

    Cuts the lineage where a later step must not compute the rows anew: what is read back
    is the same every time, also after executors are lost.
    """
    df.write.option("compression", "lz4").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
