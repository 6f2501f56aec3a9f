"""Shared helpers of the operators: scratch tables and joins that bear hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import written
from pairloom.sources.folders import delete_folder

HOT_SHARE = 1000
"""A key is hot once it has more than one in HOT_SHARE of all rows, so there are fewer
than HOT_SHARE hot keys whatever the size of the data."""

IDS_TO_BROADCAST = 500_000
"""Whole numbers: about 16 MB as a hash table."""

TEXT_ROWS = 1000
"""Rows of whole documents that go to a Python worker at once."""


def text_batches(spark: SparkSession) -> None:
    """Bound what a worker and its executor hold of texts, for the session's later jobs.

    Spark's default of 10,000 rows is meant for narrow rows. A lower setting is kept.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, TEXT_ROWS)


NARROW_ROWS = 1 << 16
"""Rows of a few numbers that go to a Python worker at once: about 1 MB."""


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """For jobs that run within and send workers nothing but numbers; the setting that
    holds for texts is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, NARROW_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


WIDE_ROWS = 32
"""Rows of a few hundred KB that a scan and a Python worker take at once."""


def wide_batches(spark: SparkSession):
    """For jobs that run within and read nothing but such rows; Spark's defaults of thousands
    of rows would hold a whole table of them. A union of tables of one task each has as many
    tasks, where Spark would put them into one. The settings are put back."""
    return _settings(
        spark,
        {
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(WIDE_ROWS),
            "spark.sql.parquet.columnarReaderBatchSize": str(WIDE_ROWS),
            "spark.sql.unionOutputPartitioning": "false",
        },
    )


def shuffles_dropped(spark: SparkSession):
    """For jobs that run within and are read from files after: Spark deletes what each has
    shuffled when it ends, and not when the driver happens to collect its garbage."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


BATCH_BYTES = 8 * 2**20
"""Bytes of text that one step of an operator holds decoded."""


def by_bytes(batches: Iterator, column: str, limit: int = BATCH_BYTES) -> Iterator:
    """Regroup Arrow batches into tables of up to `limit` bytes of text, or of one row.

    It runs in the worker; the numbers `(partition << 32) + k` are unique within a job.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    held, size, k = [], 0, 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for at, length in enumerate(lengths):
            if size and size + length > limit:
                held.append(batch.slice(start, at - start))
                yield first + k, pa.Table.from_batches(held)
                held, size, k, start = [], 0, k + 1, at
            size += length
        held.append(batch.slice(start))
    if sum(part.num_rows for part in held):
        yield first + k, pa.Table.from_batches(held)


class Scratch:
    """Tables of one operator call, in the shared folder the cluster names in
    `spark.checkpoint.dir`; only a local master may do without that setting.

    Tables that a returned DataFrame still reads live until the application ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.gettempdir()
        self.spark = spark
        self.folder = f"{root}/pairloom-{name}-{uuid.uuid4().hex}"
        self._next = 0
        atexit.register(self._sweep)

    def _sweep(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            self.drop("")

    def path(self, name: str) -> str:
        self._next += 1
        return f"{self.folder}/{self._next}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Cut the lineage: what is read back is the same each time."""
        return written(df, self.path(name))

    def drop(self, path: str) -> None:
        """Delete one table once nothing reads it any more."""
        delete_folder(self.spark, path or self.folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_row(rows: DataFrame) -> Column:
    """All columns as one, under which no name can meet an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in rows.columns])


def columns_of_row(rows: DataFrame, row: str = "row") -> list[Column]:
    """The columns of `rows` again, out of `whole_row`."""
    return [F.col(f"{row}.`{c}`") for c in rows.columns]


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of many rows with a table that is unique on `key`, without skew.

    `weight` is a column of `right`, the number of rows of `left` under the key. Keys
    over a HOT_SHARE-th of all rows are broadcast, which are fewer than HOT_SHARE; all
    others are shuffled, and no task gets more than such a share for one key.
    """
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    hot, cold = right.filter(is_hot), right.filter(~is_hot)
    if hot.isEmpty():
        return left.join(right, key)
    if cold.isEmpty():
        return left.join(F.broadcast(hot), key)
    spread = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return left.join(F.broadcast(hot), key).unionByName(spread)


def without_ids(rows: DataFrame, dropped: DataFrame, id_col: str) -> DataFrame:
    """`rows` whose id is not in `dropped(id)`, one row per id.

    Up to IDS_TO_BROADCAST ids, counted, are broadcast, so that wide rows stay where they
    are; more are joined by a shuffle. Rows without an id stay.
    """
    dropped = dropped.select(F.col("id").alias(id_col))
    if dropped.count() <= IDS_TO_BROADCAST:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, id_col, "left_anti").select(*rows.columns)
