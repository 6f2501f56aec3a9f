"""Small file-system helpers over the Hadoop API, so that any Spark path works."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_file: bool


class WriterBusy(RuntimeError):
    """Another writer holds the folder."""


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    if not fs.mkdirs(p):
        raise OSError(f"cannot create folder {path}")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def delete_file(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    if not fs.delete(p, False):
        raise OSError(f"cannot delete {path}")


def rename_file(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _open(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def _entry(status) -> Entry:
    path = status.getPath()
    return Entry(path.toString(), path.getName(), status.isFile())


def entry_of(spark: SparkSession, path: str) -> Entry | None:
    fs, p = _open(spark, path)
    return _entry(fs.getFileStatus(p)) if fs.exists(p) else None


def list_folder(spark: SparkSession, path: str) -> list[Entry]:
    """Entries of a folder in name order."""
    fs, p = _open(spark, path)
    return sorted((_entry(s) for s in fs.listStatus(p)), key=lambda e: e.name)


@dataclass(frozen=True)
class Status:
    path: str
    modified: int
    size: int


def status_of(spark: SparkSession, path: str) -> Status:
    """A file's or folder's full path, time in milliseconds and size."""
    fs, p = _open(spark, path)
    status = fs.getFileStatus(p)
    return Status(status.getPath().toString(), status.getModificationTime(), status.getLen())


def modified_at(spark: SparkSession, uri: str) -> int:
    """Modification time of a file named as `_metadata.file_path` shows it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime()


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _open(spark, source)
    to_fs, to = _open(spark, target)
    util = spark._jvm.org.apache.hadoop.fs.FileUtil
    if not util.copy(fs, p, to_fs, to, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {source} to {target}")


def glob(spark: SparkSession, pattern: str) -> list[Entry]:
    fs, p = _open(spark, pattern)
    return sorted((_entry(s) for s in fs.globStatus(p) or []), key=lambda e: e.path)


MARKER = "_SUCCESS"
WITHOUT_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
WITH_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
"""Write options that put the marker there whatever the cluster's default is."""


def check_marked(spark: SparkSession, path: str) -> None:
    """Fail unless a write to `path` has ended with its marker."""
    if not path_exists(spark, f"{path}/{MARKER}"):
        raise OSError(f"{path} was written without {MARKER}; it does not count as committed")


def scan_uri(spark: SparkSession, path: str) -> str:
    """The path as `_metadata.file_path` shows it: qualified and percent-encoded."""
    fs, p = _open(spark, path)
    uri = fs.makeQualified(p).toUri().toString()
    return re.sub(r"^([A-Za-z][\w+.-]*):///", r"\1:/", uri)


def literal_path(path: str) -> str:
    """Keep glob characters in a file name from being read as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(
    spark: SparkSession, path: str, text: str, overwrite: bool = True
) -> None:
    fs, p = _open(spark, path)
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


WRITER_GONE_AFTER = 600
"""Seconds without a sign of life after which a writer counts as dead."""


class Lease:
    """The right to write to a folder, for as long as its marker is one's own.

    The marker is written again every `WRITER_GONE_AFTER` / 10 seconds, which is the sign of
    life, by a thread of the driver; it stops with the driver, however long a job runs.
    """

    def __init__(self, spark: SparkSession, marker: str, text: str) -> None:
        self.spark, self.marker, self.text = spark, marker, text
        self._over, self._writing = threading.Event(), threading.RLock()
        self._thread = threading.Thread(target=self._renew, daemon=True)
        self._thread.start()

    def held(self) -> bool:
        with self._writing:
            there = path_exists(self.spark, self.marker)
            return there and read_text(self.spark, self.marker) == self.text

    def check(self) -> None:
        """Fail if another writer has taken over; to be asked right before a commit."""
        if not self.held():
            raise WriterBusy(f"{self.marker} was taken over; nothing more is written")

    def _renew(self) -> None:
        while not self._over.wait(max(WRITER_GONE_AFTER, 1) / 10):
            try:
                with self._writing:
                    if not self.held():
                        return
                    write_text(self.spark, self.marker, self.text)
            except Exception:  # noqa: BLE001
                # A sign of life that fails is made up for by the next; `check` decides.
                continue

    def release(self) -> None:
        self._over.set()
        self._thread.join()
        if self.held():
            delete_file(self.spark, self.marker)


@contextmanager
def single_writer(spark: SparkSession, folder: str, owner: str) -> Iterator[Lease]:
    """Hold `folder` for one writer; a second one fails at once.

    The marker is created with "fail if it exists" and holds the owner and a token of the
    Spark application. A stream that was restarted takes its own marker again if that has
    shown no sign of life for `WRITER_GONE_AFTER` seconds; any other left-over marker is
    named in the error and has to be deleted by hand. Only one's own marker is deleted
    at the end. Who commits asks the lease first, so a writer that was cut off, and taken
    for dead, does not commit when it comes back.
    """
    marker = f"{folder}/_writer"
    mine = f"{owner} [{spark.sparkContext.applicationId} {uuid.uuid4().hex}]"
    try:
        write_text(spark, marker, mine, overwrite=False)
    except Exception as error:
        if not path_exists(spark, marker):
            raise
        holder = read_text(spark, marker)
        age = time.time() - modified_at(spark, scan_uri(spark, marker)) / 1000
        own = holder.rpartition(" [")[0] == owner
        if not own or age < WRITER_GONE_AFTER:
            raise WriterBusy(
                f"{folder} is being written by {holder!r}; if that job is gone, delete {marker}"
            ) from error
        write_text(spark, marker, mine)
    lease = Lease(spark, marker, mine)
    try:
        yield lease
    finally:
        lease.release()
