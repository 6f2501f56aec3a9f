"""JSON Lines files as a DataFrame of lines that remember where they stood."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.folders import (
    copy_file,
    entry_of,
    list_folder,
    literal_path,
    path_exists,
    scan_uri,
)

NOT_RECORDS = ("_SUCCESS", "_temporary", "_committed", "_started", "_spark_metadata")
"""What writers leave in a folder beside their files."""


@dataclass(frozen=True)
class InputFile:
    """One argument of a load: `uri` is None when there is no such file, or when it is a
    folder inside a folder."""

    path: str
    uri: str | None
    is_folder: bool = False


def no_records(names: set[str], name: str) -> bool:
    """Whether a file in a folder of `names` is none of records: what writers leave there,
    or the checksum `.name.crc` of another file."""
    checked = name.removeprefix(".").removesuffix(".crc")
    return name in NOT_RECORDS or (name == f".{checked}.crc" and checked in names)


def no_record_file(spark: SparkSession, folder: str, name: str) -> bool:
    """`no_records` for one file, without the names of all others."""
    checked = name.removeprefix(".").removesuffix(".crc")
    there = name == f".{checked}.crc" and path_exists(spark, f"{folder}/{checked}")
    return no_records({checked} if there else set(), name)


def find_files(
    spark: SparkSession, paths: Iterable[str], staging: str, ignored: list[str] | None = None
) -> list[InputFile]:
    """Resolve arguments in order. A folder stands for the files in it, by name; a file
    given twice is listed twice. What `no_records` passes over is added to `ignored`.

    Spark's readers pass over names that begin with `_` or `.`. Such a file is copied to
    `staging` under a plain name and read there.
    """
    found = []
    for path in paths:
        entry = entry_of(spark, path)
        if entry is None:
            found.append(InputFile(path, None))
        elif entry.is_file:
            found.append(InputFile(path, _readable(spark, path, entry.name, staging)))
        else:
            entries = list_folder(spark, path)
            names = {e.name for e in entries}
            for e in entries:
                if no_records(names, e.name):
                    if ignored is not None:
                        ignored.append(e.path)
                elif e.is_file:
                    found.append(InputFile(e.path, _readable(spark, e.path, e.name, staging)))
                else:
                    found.append(InputFile(e.path, None, is_folder=True))
    return found


def _readable(spark: SparkSession, path: str, name: str, staging: str) -> str:
    if not name.startswith((".", "_")):
        return scan_uri(spark, path)
    # One copy for a file that is given twice.
    copy = f"{staging}/{hashlib.sha256(path.encode()).hexdigest()}.jsonl"
    if entry_of(spark, copy) is None:
        copy_file(spark, path, copy)
    return scan_uri(spark, copy)


def line_columns() -> list:
    return [
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ]


def number_in_task(lines: DataFrame) -> DataFrame:
    """Add `mid`, which grows by one per line within a split of a file.

    Splits are read whole by one task each, so `(file, block_start, mid)` is the order
    of the lines in the files. It has to be taken on the scan itself, before any filter.
    """
    return lines.withColumn("mid", F.monotonically_increasing_id())


def scan_lines(spark: SparkSession, files: Iterable[InputFile]) -> DataFrame:
    """All lines of the files: `(value, file_path, block_start, mid)`.

    Lines end at `\\n` only; Spark's default would also break at a lone `\\r`. A file
    given twice is read once, see `operators.numbering`.
    """
    unique = list(dict.fromkeys(f.uri for f in files if f.uri is not None))
    if not unique:
        empty = "value string, file_path string, block_start long, mid long"
        return spark.createDataFrame([], empty)
    text = spark.read.option("lineSep", "\n").text(
        [literal_path(unquote(uri)) for uri in unique]
    )
    return number_in_task(text.select(*line_columns()))
