"""Which files a scheduled load has taken, as Parquet tables beside one another.

    <log>/plans/number=<n>/part-*.parquet, _SUCCESS    the files of load n
    <log>/<n>.done                                     load n is stored
    <log>/states/number=<n>/part-*.parquet, _SUCCESS   all files as of load n

A plan or state counts once its marker is there. What has been seen is the newest state and
the plans after it, joined with the listing of the folder: neither the driver nor any plan
holds a row for every file. A state replaces those before it every `LOADS_PER_STATE` loads,
so a run reads a bounded number of folders however old the log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.folders import (
    MARKER,
    WITH_MARKER,
    check_marked,
    delete_file,
    delete_folder,
    glob,
    literal_path,
    path_exists,
    status_of,
)
from pairloom.sources.jsonl import no_record_file

FILE_SCHEMA = "path string, modified long, size long"
SEEN_SCHEMA = f"{FILE_SCHEMA}, number long"
LOADS_PER_STATE = 32

FileChange = tuple[str, int, int]
"""Path, time in milliseconds and size."""


def files_in(
    spark: SparkSession, folder: str, ignored: list[str] | None = None
) -> DataFrame:
    """`(path, modified, size)` of the files right in a folder that are not empty.

    Spark lists them and its tasks look at each, without a call or a row in the driver. Names
    that begin with `_` or `.`, which Spark passes over, are few and listed by the driver;
    those that are none of records (`sources.jsonl`) are added to `ignored`. A file that
    goes away meanwhile is not listed.
    """
    root = status_of(spark, folder).path
    name = F.substring_index("path", "/", -1)
    plain = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .load(literal_path(folder))
        .where(F.col("path") == F.concat(F.lit(f"{root.rstrip('/')}/"), name))
        .select(
            "path",
            F.unix_millis("modificationTime").alias("modified"),
            F.col("length").alias("size"),
        )
    )
    hidden = []
    for entry in glob(spark, f"{literal_path(folder)}/{{_,.}}*"):
        if not entry.is_file:
            continue
        if no_record_file(spark, folder, entry.name):
            if ignored is not None:
                ignored.append(entry.path)
        elif (found := status_of(spark, entry.path)).size:
            hidden.append((found.path, found.modified, found.size))
    return plain.unionByName(spark.createDataFrame(hidden, FILE_SCHEMA)) if hidden else plain


class ChangeLog:
    """The log of one scheduled load. Its caller holds the log as its single writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/number={number}"

    def _numbers(self, kind: str) -> list[int]:
        markers = glob(self.spark, f"{self.path}/{kind}/number=*/{MARKER}")
        return sorted(int(m.path.rsplit("/", 2)[-2].partition("=")[2]) for m in markers)

    def _state(self) -> int:
        return max(self._numbers("states"), default=0)

    def last(self) -> int:
        """Number of the newest plan, 0 before the first.

        Logs of an earlier form hold `<n>.plan`, whose numbers are not given again: loads
        of that name may be stored. Their files count as not seen.
        """
        plans = glob(self.spark, f"{self.path}/*.plan")
        earlier = [int(e.name.removesuffix(".plan")) for e in plans]
        return max([self._state(), *self._numbers("plans"), *earlier])

    def unfinished(self) -> int | None:
        """The newest plan, if its load is not done."""
        newest = max(self._numbers("plans"), default=0)
        return newest if newest and not self.is_done(newest) else None

    def done_path(self, number: int) -> str:
        return f"{self.path}/{number}.done"

    def is_done(self, number: int) -> bool:
        return number <= self._state() or path_exists(self.spark, self.done_path(number))

    def plan(self, number: int, files: list[FileChange]) -> None:
        """Note the files of a load before it starts; they are at most one load's."""
        rows = self.spark.createDataFrame([(*file, number) for file in files], SEEN_SCHEMA)
        self._write(rows.coalesce(1), self._folder("plans", number))

    def files_of(self, number: int) -> list[FileChange]:
        """The files of a plan in the order they are loaded."""
        plan = self._read([self._folder("plans", number)])
        return [(r.path, r.modified, r.size) for r in plan.orderBy("modified", "path").collect()]

    def seen(self) -> DataFrame:
        """Each file ever planned, as it was the last time, with the number of that load."""
        state = self._state()
        folders = [self._folder("states", state)] if state else []
        folders += [self._folder("plans", n) for n in self._numbers("plans") if n > state]
        if not folders:
            return self.spark.createDataFrame([], SEEN_SCHEMA)
        last = F.max(F.struct("number", "modified", "size")).alias("last")
        return (
            self._read(folders)
            .groupBy("path")
            .agg(last)
            .select("path", "last.modified", "last.size", "last.number")
        )

    def changed(self, files: DataFrame) -> DataFrame:
        """Those of `files` that are new, or of another time or size than the last time."""
        return files.join(
            self.seen().drop("number"), ["path", "modified", "size"], "left_anti"
        )

    def shorten(self) -> None:
        """Put one state in place of the plans, if there are many, and all are done."""
        state, last = self._state(), self.last()
        if last - state < LOADS_PER_STATE or not self.is_done(last):
            return
        self._write(self.seen(), self._folder("states", last))
        # What the new state stands for; a crash in between leaves folders nobody reads.
        for kind in ("plans", "states"):
            for number in self._numbers(kind):
                if (kind, number) != ("states", last):
                    delete_folder(self.spark, self._folder(kind, number))
        for mark in glob(self.spark, f"{self.path}/*.done"):
            delete_file(self.spark, mark.path)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").options(**WITH_MARKER).parquet(path)
        check_marked(self.spark, path)

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(SEEN_SCHEMA).parquet(*folders)
