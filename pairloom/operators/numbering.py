"""Line numbers over many files and splits, without a global sort or window.

A split of a file is read by one task, which counts its lines in `mid`. What is missing
is how many lines came before the split. That follows from one row per split (a 100 TB
input has under a million), so the lines themselves are never shuffled or sorted. More
splits than can be broadcast at once are taken in groups of the tasks that read them: `mid`
holds the task's number, so a group is a range of `mid`, which the statistics of the written
lines select without reading the others.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.functions.record import FAILED, OK, OVERLONG

# A split row takes some 100 bytes in a broadcast, so this is about 100 MB. A task's splits
# are not parted, but they are few.
SPLITS_TO_BROADCAST = 1_000_000
# Files whose order is broadcast to the split table; more are joined by a shuffle of that table.
FILES_TO_BROADCAST = 100_000
# `monotonically_increasing_id` holds the task's number above the row's in 33 bits.
TASK_BITS = 33


@dataclass(frozen=True)
class FileLines:
    """What the splits of one file add up to. `cut` is the place of its first over-long
    line, from which on nothing is read."""

    lines: int
    ok: int
    failed: int
    key_bytes: int
    splits: int
    cut: tuple[int, int] | None


def split_table(checked: DataFrame) -> DataFrame:
    """One row per split of a file, with the number of lines before it in the file."""
    ok = F.col("status") == OK
    splits = checked.groupBy("file_path", "block_start").agg(
        F.min("mid").alias("first_mid"),
        F.count("*").alias("lines"),
        F.count_if(ok).alias("ok"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.coalesce(F.sum(F.octet_length("rec.task_id").cast("long")), F.lit(0)).alias(
            "key_bytes"
        ),
        F.min(F.when(F.col("status") == OVERLONG, F.col("mid"))).alias("cut_mid"),
    )
    before = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return splits.withColumn(
        "lines_before", F.coalesce(F.sum("lines").over(before), F.lit(0))
    )


def lines_per_file(splits: DataFrame) -> dict[str, FileLines]:
    """Roll the split table up to one entry per input file."""
    cut = F.when(F.col("cut_mid").isNotNull(), F.struct("block_start", "cut_mid"))
    rows = splits.groupBy("file_path").agg(
        F.sum("lines").alias("lines"),
        F.sum("ok").alias("ok"),
        F.sum("failed").alias("failed"),
        F.sum("key_bytes").alias("key_bytes"),
        F.count("*").alias("splits"),
        F.min(cut).alias("cut"),
    )
    return {
        r.file_path: FileLines(
            r.lines,
            r.ok,
            r.failed,
            r.key_bytes,
            r.splits,
            tuple(r.cut) if r.cut else None,
        )
        for r in rows.collect()
    }


def number_lines(
    spark: SparkSession,
    checked: DataFrame,
    splits: DataFrame,
    files: Iterable[str],
    per_file: dict[str, FileLines],
) -> DataFrame:
    """Add `file_ord`, `line` and `line_no`, and drop what lies behind an over-long line.

    `files` are the file paths in reading order. `line` counts the lines of all of them
    from 0; `line_no` counts those of one file from 1. A file named twice gives its
    lines twice, under two `file_ord`.
    """
    rows, base = [], 0
    for ord_, path in enumerate(files):
        seen = per_file.get(path)
        if seen is not None:
            rows.append((path, ord_, base, *(seen.cut or (None, None))))
            base += seen.lines
    schema = "file_path string, file_ord int, base long, cut_block long, cut_at long"
    order = spark.createDataFrame(rows, schema)
    if len(rows) <= FILES_TO_BROADCAST:
        order = F.broadcast(order)
    places = splits.join(order, "file_path").select(
        "file_path",
        "block_start",
        "file_ord",
        (F.col("base") + F.col("lines_before") - F.col("first_mid")).alias("to_line"),
        (F.col("lines_before") - F.col("first_mid") + 1).alias("to_line_no"),
        "cut_block",
        "cut_at",
        F.shiftright("first_mid", TASK_BITS).alias("task"),
    )
    if sum(per_file[r[0]].splits for r in rows) <= SPLITS_TO_BROADCAST:
        parts = [(checked, places)]
    else:
        parts = [
            (
                checked.where(F.col("mid").between(low << TASK_BITS, ((high + 1) << TASK_BITS) - 1)),
                places.where(F.col("task").between(low, high)),
            )
            for low, high in _task_ranges(places)
        ]
    cut = any(seen.cut for seen in per_file.values())
    numbered = reduce(
        DataFrame.unionByName,
        [_with_places(lines, here, cut) for lines, here in parts],
    )
    return numbered.drop("block_start", "mid")


def _task_ranges(places: DataFrame) -> list[tuple[int, int]]:
    """First and last task of groups with at most `SPLITS_TO_BROADCAST` rows, or one task."""
    ranges, size = [], 0
    for row in places.groupBy("task").count().orderBy("task").toLocalIterator():
        if ranges and size + row["count"] <= SPLITS_TO_BROADCAST:
            ranges[-1], size = (ranges[-1][0], row.task), size + row["count"]
        else:
            ranges.append((row.task, row.task))
            size = row["count"]
    return ranges


def _with_places(lines: DataFrame, places: DataFrame, cut: bool) -> DataFrame:
    placed = (
        lines.join(F.broadcast(places.drop("task")), ["file_path", "block_start"])
        .withColumn("line", F.expr("to_line + mid"))
        .withColumn("line_no", F.expr("to_line_no + mid"))
    )
    if cut:
        placed = placed.where(
            "cut_block is null or block_start < cut_block"
            " or (block_start = cut_block and mid < cut_at)"
        )
    return placed.drop("to_line", "to_line_no", "cut_block", "cut_at")
