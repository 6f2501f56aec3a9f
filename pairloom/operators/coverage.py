"""How the pairs are spread over the classification axes.

The operators take column names, so they count any table. What they return is as small
as the number of distinct values; what they read is the named columns only.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import utc_now_text
from pairloom.taxonomy import AXIS_COLUMNS, TAG_AXIS, TAG_COLUMN

CROSS_AXES = ("domain", "difficulty")
CROSS_NAME = "domain_x_difficulty"
MAP_FIELDS = ("domain", "difficulty", "task_shape", "capability", CROSS_NAME)


def check_column(column: str, allowed: Collection[str] = AXIS_COLUMNS) -> str:
    """Refuse to group by anything but the listed columns."""
    if column not in allowed:
        names = ", ".join(allowed)
        raise ValueError(f"invalid column name: {column!r} (allowed: {names})")
    return column


def total_count(df: DataFrame) -> DataFrame:
    """One row `(n)`."""
    return df.agg(F.count("*").alias("n"))


def axis_counts(
    df: DataFrame, column: str, allowed: Collection[str] = AXIS_COLUMNS
) -> DataFrame:
    """`(key, n)`: rows per value of one column."""
    check_column(column, allowed)
    return df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))


def tag_counts(df: DataFrame, column: str = TAG_COLUMN) -> DataFrame:
    """`(key, n)`: how often each list element occurs. Empty lists give nothing, and an
    element twice in one row counts twice."""
    return (
        df.select(F.explode(column).alias("key"))
        .groupBy("key")
        .agg(F.count("*").alias("n"))
    )


def cross_counts(
    df: DataFrame, column_a: str, column_b: str, allowed: Collection[str] = AXIS_COLUMNS
) -> DataFrame:
    """`(a, b, key, n)`: rows per pair of values; `key` is `a:b`."""
    a = F.col(check_column(column_a, allowed)).alias("a")
    b = F.col(check_column(column_b, allowed)).alias("b")
    pairs = df.groupBy(a, b).agg(F.count("*").alias("n"))
    return pairs.select("a", "b", _pair_key("a", "b").alias("key"), "n")


def _pair_key(a: str, b: str) -> Column:
    return F.concat(F.col(a), F.lit(":"), F.col(b))


def coverage_parts(df: DataFrame) -> DataFrame:
    """All counts as `(axis, a, b, n)`, from one scan of four columns.

    Every row is expanded into its axis values first, and these are counted map-side in
    the only aggregate. That leaves about as many rows per task as there are values,
    whatever the order and repetition of the tags in a list. The parts of two tables add up
    to those of both, see `added_parts`.
    """
    entries = [_entry(axis, F.col(axis)) for axis in AXIS_COLUMNS] + [
        _entry("total", F.lit("")),
        _entry(CROSS_NAME, F.col(CROSS_AXES[0]), F.col(CROSS_AXES[1])),
    ]
    no_tags = F.array().cast("array<string>")
    tags = F.transform(
        F.coalesce(TAG_COLUMN, no_tags), lambda tag: _entry(TAG_AXIS, tag)
    )
    exploded = df.select(F.explode(F.concat(F.array(*entries), tags)).alias("e"))
    return exploded.groupBy("e.axis", "e.a", "e.b").agg(F.count("*").alias("n"))


def added_parts(parts: DataFrame) -> DataFrame:
    """The parts of several tables, one below the other, as those of all of them."""
    return parts.groupBy("axis", "a", "b").agg(F.sum("n").alias("n"))


def named_parts(parts: DataFrame) -> DataFrame:
    """Parts as `(axis, key, n)`."""
    key = F.when(F.col("axis") == CROSS_NAME, _pair_key("a", "b")).otherwise(F.col("a"))
    return parts.select("axis", key.alias("key"), "n")


def coverage_long(df: DataFrame) -> DataFrame:
    """All counts as `(axis, key, n)`, see `coverage_parts`."""
    return named_parts(coverage_parts(df))


def _entry(axis: str, a: Column, b: Column | None = None) -> Column:
    second = F.lit("") if b is None else b
    return F.struct(F.lit(axis).alias("axis"), a.alias("a"), second.alias("b"))


def coverage_document(df: DataFrame) -> DataFrame:
    """One row: `total_count`, five maps from value to count, `generated_at`.

    An empty table gives a total of 0 and empty maps. Map entries are in key order. NULL
    cannot be a key of a map: such values are in the total only. Two
    value pairs that read the same as `a:b` cannot both be in the map; the larger count
    is kept (`coverage_long` keeps both).
    """
    return document_of(coverage_long(df))


def document_of(long: DataFrame) -> DataFrame:
    """The coverage document of the counts `(axis, key, n)`."""
    counts = long.groupBy("axis", "key").agg(F.max("n").alias("n"))

    def axis_map(axis: str) -> Column:
        wanted = (F.col("axis") == axis) & F.col("key").isNotNull()
        entry = F.when(wanted, F.struct("key", "n"))
        entries = F.array_sort(F.collect_list(entry))
        return F.map_from_entries(entries).alias(axis)

    total = F.max(F.when(F.col("axis") == "total", F.col("n")))
    return counts.agg(
        F.coalesce(total, F.lit(0)).alias("total_count"),
        *[axis_map(axis) for axis in MAP_FIELDS],
    ).withColumn("generated_at", utc_now_text())


def sum_over(counts: DataFrame, axes: Sequence[str]) -> DataFrame:
    """`(axis, n)`: the counts of some axes added up, for consistency checks."""
    return (
        counts.where(F.col("axis").isin(*axes))
        .groupBy("axis")
        .agg(F.sum("n").alias("n"))
    )
