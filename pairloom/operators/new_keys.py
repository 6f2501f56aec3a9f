"""Insert-if-absent: which rows carry a key for the first time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 32 MB of keys and row numbers may be broadcast; the caller measures them.
KEY_BYTES_TO_BROADCAST = 32 << 20
# A row number takes some 24 bytes in a broadcast hash table, so this is about 100 MB.
LINES_TO_BROADCAST = 4_000_000
# Spark's bitmaps hold 32,768 numbers in 4 KB, so this is 64 MB of bitmaps.
SPAN_TO_BROADCAST = (64 << 20) * 8


def first_of_each(rows: DataFrame, key: str = "task_id") -> DataFrame:
    """The first row of every key by `line`: `(key, line, file_ord)`.

    An aggregate rather than a ranking window: it is combined before the shuffle, so a
    key that fills a third of the input sends one row per task.
    """
    return rows.groupBy(key).agg(
        F.min("line").alias("line"), F.min_by("file_ord", "line").alias("file_ord")
    )


def not_stored(
    first: DataFrame, stored: DataFrame, key: str = "task_id", small: bool = False
) -> DataFrame:
    """The rows of `first` whose key is not in `stored`.

    With `small`, `first` fits a broadcast: the store is streamed past it and only row
    groups inside the range of the new keys are read, so a small load moves nothing of
    the store. Otherwise both sides, one narrow row per key, are shuffled by key.
    """
    keys = stored.select(key)
    if not small:
        return first.join(keys, key, "left_anti")
    low, high = first.agg(F.min(key), F.max(key)).first()
    if low is None:
        return first
    hits = keys.where(F.col(key).between(low, high)).join(
        F.broadcast(first.select(key)), key, "left_semi"
    )
    return first.join(F.broadcast(hits), key, "left_anti")


def keep_lines(
    rows: DataFrame, lines: DataFrame, kept: int, total: int, span: int
) -> DataFrame:
    """The rows whose `line` is among `lines`: `kept` of `total` rows, of an input that
    is `span` lines long.

    The rows stay where they are while the smaller of "kept" and "dropped" fits a
    broadcast as numbers, or the span fits one as bitmaps. Beyond that they are shuffled
    once, in runs of 32,768 lines, so that stored files still cover narrow id ranges.
    """
    dropped = total - kept
    if dropped == 0:
        return rows
    wanted = lines.select("line")
    if kept <= LINES_TO_BROADCAST and kept <= dropped:
        return rows.join(F.broadcast(wanted), "line", "left_semi")
    if dropped <= LINES_TO_BROADCAST:
        unwanted = rows.select("line").join(wanted, "line", "left_anti")
        return rows.join(F.broadcast(unwanted), "line", "left_anti")
    bitmaps = line_bitmaps(wanted)
    if span <= SPAN_TO_BROADCAST:
        bitmaps = F.broadcast(bitmaps)
    run = F.bitmap_bucket_number(F.col("line") + 1)
    position = F.bitmap_bit_position(F.col("line") + 1)
    return (
        rows.withColumn("run", run)
        .join(bitmaps, "run")
        .where(bit_is_set(F.col("bitmap"), position))
        .drop("run", "bitmap")
    )


def line_bitmaps(lines: DataFrame) -> DataFrame:
    """`(run, bitmap)`: the lines as one bit each, per run of 32,768."""
    number = F.col("line") + 1
    return lines.groupBy(F.bitmap_bucket_number(number).alias("run")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def bit_is_set(bitmap: Column, position: Column) -> Column:
    byte = F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(value, (position % 8).cast("int")) == 1
