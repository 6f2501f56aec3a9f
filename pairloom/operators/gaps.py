"""Which parts of the taxonomy have few pairs or none.

The taxonomy side of every join is a fixed word list (30 values; at most 1,872 cells), so
broadcasting it is safe whatever the size of the collection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.coverage import CROSS_AXES, coverage_long
from pairloom.taxonomy import (
    TAG_AXIS,
    TAG_COLUMN,
    TAXONOMY,
    Taxonomy,
    cell_frame,
    taxonomy_frame,
)


def axis_gaps(df: DataFrame, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """`(axis, ord, value, n)` for every taxonomy value, 0 where there is no pair."""
    values = taxonomy_frame(df.sparkSession, taxonomy).select("axis", "ord", "value")
    counts = coverage_long(df).withColumnRenamed("key", "value")
    return _zero_filled(values, counts, ["axis", "value"]).select(
        "axis", "ord", "value", "n"
    )


def cell_counts(
    df: DataFrame, axes: Sequence[str] = CROSS_AXES, taxonomy: Taxonomy = TAXONOMY
) -> DataFrame:
    """`(<axes>, n)`: pairs per combination; a pair counts once per capability tag where
    `capability` is one of the axes."""
    for axis in axes:
        if axis not in taxonomy:
            raise ValueError(f"invalid axis: {axis!r} (allowed: {', '.join(taxonomy)})")
    values = [F.explode(TAG_COLUMN).alias(axis) if axis == TAG_AXIS else axis for axis in axes]
    return df.select(*values).groupBy(*axes).agg(F.count("*").alias("n"))


def cell_gaps(
    df: DataFrame, axes: Sequence[str] = CROSS_AXES, taxonomy: Taxonomy = TAXONOMY
) -> DataFrame:
    """`(<axes>, ord_<axes>, n)` for every combination of taxonomy values."""
    cells = cell_frame(df.sparkSession, axes, taxonomy)
    return _zero_filled(cells, cell_counts(df, axes, taxonomy), list(axes))


def _zero_filled(cells: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    # The counts may hold any number of values from outside the taxonomy. The inner join
    # leaves at most one row per cell, which makes the second broadcast safe too.
    known = counts.join(F.broadcast(cells.select(*keys)), keys)
    return cells.join(F.broadcast(known.select(*keys, "n")), keys, "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def next_targets(
    df: DataFrame,
    k: int,
    axes: Sequence[str] = CROSS_AXES,
    taxonomy: Taxonomy = TAXONOMY,
) -> DataFrame:
    """The `k` combinations with the fewest pairs, ties in taxonomy order, as
    `(rank, <axes>, n)`."""
    if k <= 0:
        raise ValueError(f"k must be > 0, got {k}")
    order = ["n", *[f"ord_{axis}" for axis in axes]]
    lowest = cell_gaps(df, axes, taxonomy).orderBy(*order).limit(k)
    ranked = lowest.agg(F.array_sort(F.collect_list(F.struct(*order, *axes))).alias("c"))
    return ranked.select(F.posexplode("c").alias("pos", "c")).select(
        (F.col("pos") + 1).cast("long").alias("rank"), *[F.col(f"c.{a}") for a in axes], "c.n"
    )


def off_taxonomy(df: DataFrame, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """`(axis, value, n)`: values that occur but are not in the taxonomy."""
    values = taxonomy_frame(df.sparkSession, taxonomy).select("axis", "value")
    counts = coverage_long(df).where(F.col("axis").isin(*taxonomy))
    return counts.withColumnRenamed("key", "value").join(
        F.broadcast(values), ["axis", "value"], "left_anti"
    )
