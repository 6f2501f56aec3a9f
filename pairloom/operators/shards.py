"""Cut a table into shards of exactly `size` rows in id order.

A global `row_number()` would put the whole table into one task. What is needed instead
is the id each shard starts at, and that follows from the id column alone:

* ids without gaps: arithmetic on the lowest and the highest id;
* any other ids: a histogram over id ranges, a running sum of its counts, and the rank of
  an id inside its range. A range with more than a few shards' rows is cut into narrower
  ones, from counts alone, until none is left, so one id far off the others, or a crowd in
  a wide field, makes no range that a task could not bear.

With the starts known, the rows themselves are moved once, straight to their shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import written

# The histogram starts with, and each cut adds, at most this many ranges, so it can be
# broadcast (24 bytes each).
MAX_RANGES = 1_000_000
# A range with the rows of more shards is cut.
SHARDS_PER_RANGE = 4
MOST_ID = (1 << 63) - 1
# Running sums are taken inside groups of this many ranges, and over the groups.
RANGES_PER_GROUP = 1_000


@dataclass(frozen=True)
class IdStats:
    rows: int
    low: int | None
    high: int | None

    @property
    def dense(self) -> bool:
        return self.rows > 0 and self.high - self.low + 1 == self.rows


@dataclass(frozen=True)
class ShardMap:
    """Which shard an id belongs to. `starts[k]` is the lowest id of shard `k`; there are
    `segments` only where ids have gaps."""

    stats: IdStats
    size: int
    id_column: str
    starts: Sequence[int]
    segments: DataFrame | None = None
    cuts: Sequence[tuple[int, DataFrame]] = ()
    """For each cut of the histogram, the new width and the `(start)` of the ranges cut."""

    @property
    def shards(self) -> int:
        return len(self.starts)

    def rows_in(self, shard: int) -> int:
        return min(self.size, self.stats.rows - shard * self.size)

    def assign(self, df: DataFrame, first: int, last: int) -> DataFrame:
        """The rows of the shards `first..last`, with their number in `shard`.

        The id range is a plain filter, which Parquet checks against row-group bounds.
        """
        end = (
            self.stats.high
            if last == self.shards - 1
            else self.starts[last + 1] - 1
        )
        ids = F.col(self.id_column)
        rows = df.where(ids.between(self.starts[first], end))
        if self.segments is None:
            return rows.withColumn(
                "shard", id_range(self.id_column, self.stats.low, self.size)
            )
        wanted = self.segments.where(F.col("shard").between(first, last))
        rows = with_range(rows, self, self.id_column, "id_bucket")
        inside = (
            (F.col("id_bucket") == F.col("bucket"))
            & (ids >= F.col("from_id"))
            & (ids < F.col("to_id"))
        )
        return (
            rows.join(F.broadcast(wanted), inside)
            .drop("id_bucket", "bucket", "from_id", "to_id")
        )


def id_range(id_column: str, low: int, width: int) -> Column:
    """Number of the range of `width` ids, counted from `low`, that an id lies in."""
    return F.expr(f"(`{id_column}` - {low}L) div {width}L")


def range_width(of) -> int:
    """Width of a range before any cut: a shard's worth of ids, or more where the ids are
    spread so wide that there would be too many ranges."""
    spread = of.stats.high - of.stats.low + 1
    return max(of.size, -(-spread // MAX_RANGES))


def id_stats(df: DataFrame, id_column: str = "id") -> IdStats:
    row = df.agg(
        F.count("*").alias("rows"),
        F.count(id_column).alias("ids"),
        F.min(id_column).alias("low"),
        F.max(id_column).alias("high"),
    ).first()
    if row.ids != row.rows:
        raise ValueError(f"{row.rows - row.ids} row(s) without {id_column}")
    return IdStats(row.rows, row.low, row.high)


def shard_map(df: DataFrame, size: int, work: str, id_column: str = "id") -> ShardMap:
    """Find the starts of all shards of `size` rows. Ids have to be unique.

    `df` has to give the same rows every time it is read, as a stored table does; `work`
    is a folder for the small tables of the histogram.
    """
    stats = id_stats(df, id_column)
    if stats.rows == 0:
        return ShardMap(stats, size, id_column, [])
    if stats.dense:
        starts = range(stats.low, stats.high + 1, size)
        return ShardMap(stats, size, id_column, starts)
    return _map_with_gaps(df, ShardMap(stats, size, id_column, []), work)


def with_range(df: DataFrame, of: ShardMap, id_column: str, name: str) -> DataFrame:
    """Add the lowest id of the range that an id lies in, after all cuts.

    A range that was cut is looked up among those cut, which are fewer than the shards; the
    rest is arithmetic, so rows stay where they are.
    """
    low, width = of.stats.low, range_width(of)
    start = id_range(id_column, low, width) * F.lit(width) + F.lit(low)
    df = df.withColumn(name, start)
    for width, cut in of.cuts:
        cut = cut.select(F.col("start").alias("cut_start"))
        inner = F.expr(f"`{name}` + (`{id_column}` - `{name}`) div {width}L * {width}L")
        df = (
            df.join(F.broadcast(cut), F.col(name) == F.col("cut_start"), "left")
            .withColumn(name, F.when(F.col("cut_start").isNull(), F.col(name)).otherwise(inner))
            .drop("cut_start")
        )
    return df


def _histogram(ids: DataFrame, of: ShardMap, work: str) -> tuple[DataFrame, ShardMap]:
    """`(start, width, n)` of every range with ids, and the cuts that led to them."""
    most = SHARDS_PER_RANGE * of.size
    width, counted, final = range_width(of), ids, None
    while True:
        level = len(of.cuts)
        ranges = with_range(counted, of, "id", "start").groupBy("start")
        ranges = written(
            ranges.agg(F.count("*").alias("n")).withColumn("width", F.lit(width)),
            f"{work}/ranges{level}",
        )
        crowded = ranges.where((F.col("n") > most) & (F.col("width") > 1))
        n_crowded = crowded.count()
        done = ranges.where((F.col("n") <= most) | (F.col("width") <= 1))
        final = done if final is None else final.unionByName(done)
        if not n_crowded:
            return final, of
        crowded = written(crowded.select("start"), f"{work}/crowded{level}")
        pieces = max(2, MAX_RANGES // n_crowded)
        # Only ids in crowded ranges are counted again.
        inside = with_range(ids, of, "id", "start").join(F.broadcast(crowded), "start", "left_semi")
        counted = inside.select("id")
        width = -(-width // pieces)
        of = replace(of, cuts=[*of.cuts, (width, crowded)])


def _map_with_gaps(df: DataFrame, empty: ShardMap, work: str) -> ShardMap:
    low, size = empty.stats.low, empty.size
    ids = df.select(F.col(empty.id_column).alias("id"))
    ranges, empty = _histogram(ids, empty, work)
    histogram = written(_running_sum(ranges, low, range_width(empty)), f"{work}/histogram")
    ids = with_range(ids, empty, "id", "bucket")

    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
    indexed = ids.join(F.broadcast(histogram), "bucket").withColumn(
        "index", F.col("before") + rank - 1
    )
    at_start = indexed.where(f"index % {size} = 0").select(
        F.expr(f"index div {size}").alias("shard"), "bucket", "id"
    )
    starts = written(at_start, f"{work}/starts")

    # A range is cut at the starts that lie in it; its first piece belongs to the shard
    # that was open at the end of the range before.
    open_shard = F.expr(f"(before + {size - 1}) div {size} - 1")
    pieces = histogram.select("bucket", F.col("bucket").alias("from_id"), open_shard.alias("shard"))
    pieces = pieces.union(starts.select("bucket", "id", "shard"))
    following = F.lead("from_id").over(
        Window.partitionBy("bucket").orderBy("from_id", "shard")
    )
    ends = histogram.select("bucket", F.col("end").alias("range_end"))
    pieces = (
        pieces.withColumn("to_id", following)
        .join(F.broadcast(ends), "bucket")
        .withColumn("to_id", F.coalesce("to_id", "range_end"))
        .where("from_id < to_id")
        .select("bucket", "from_id", "shard", "to_id")
    )
    segments = written(pieces, f"{work}/segments")

    # One number per output file, as many as the writer has to name anyway.
    first_ids = [r.id for r in starts.orderBy("shard").select("id").collect()]
    return replace(empty, starts=first_ids, segments=segments)


def _running_sum(ranges: DataFrame, low: int, width: int) -> DataFrame:
    """`(bucket, end, before)`: the rows in all lower ranges, and where a range ends.

    No id lies at the top of the long range's end, so an end beyond it is cut there.
    """
    spark = ranges.sparkSession
    part = id_range("bucket", low, width * RANGES_PER_GROUP)
    end = F.least(
        F.col("bucket").cast("decimal(38,0)") + F.col("width"), F.lit(MOST_ID).cast("decimal(38,0)")
    ).cast("long")
    counts = ranges.select(F.col("start").alias("bucket"), "n", end.alias("end"))
    grouped = counts.withColumn("part", part)
    # At most MAX_RANGES / RANGES_PER_GROUP rows.
    sums = grouped.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = list(accumulate((r.n for r in sums), initial=0))
    offsets = spark.createDataFrame(
        [(r.part, b) for r, b in zip(sums, before)], "part long, offset long"
    )
    lower = (
        Window.partitionBy("part")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        grouped.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0)))
        .join(F.broadcast(offsets), "part")
        .select("bucket", "end", (F.col("offset") + F.col("lower")).alias("before"))
    )
