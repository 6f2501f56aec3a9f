"""Export: the store -> Parquet shards of a fixed size, in id order."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.shards import ShardMap, shard_map
from pairloom.schema import EXPORT_FIELDS, LIST_FIELDS, NULLABLE_FIELDS, field_type
from pairloom.session import engine_settings, work_folder
from pairloom.sources.folders import (
    delete_file,
    delete_folder,
    glob,
    list_folder,
    make_folder,
    path_exists,
    read_text,
    rename_file,
    single_writer,
    write_text,
)
from pairloom.sources.pair_store import PairStore

# Fixed values.
DEFAULT_SHARD_SIZE = 50_000
DEFAULT_COMPRESSION = "zstd"
COMPRESSIONS = ("zstd", "snappy", "gzip", "none")

# Shards written by one Spark job. It bounds the number of shuffle partitions; a larger
# export runs one job after the other, each over its own range of ids.
SHARDS_PER_JOB = 10_000
RENAMES_AT_ONCE = 16
# Names the staged shards, from when they are whole until they have been moved.
PLAN = "_publish.json"


@dataclass(frozen=True)
class ExportResult:
    rows: int
    shards: int
    directory: str

    def summary(self) -> str:
        return f"exported {self.rows} rows to {self.shards} shard(s) in {self.directory}"


def export_store(
    store: PairStore,
    output_dir: str,
    shard_size: int = DEFAULT_SHARD_SIZE,
    compression: str = DEFAULT_COMPRESSION,
) -> ExportResult:
    """Export a whole store. Unlike coverage, a store that is not there is an error."""
    check_options(shard_size, compression)
    return export_shards(store.read(), output_dir, shard_size, compression)


def check_options(shard_size: int, compression: str) -> None:
    if shard_size <= 0:
        raise ValueError(f"shard size must be > 0, got {shard_size}")
    if compression not in COMPRESSIONS:
        valid = ", ".join(COMPRESSIONS)
        raise ValueError(f"unsupported compression {compression!r} (valid: {valid})")


def export_shards(
    pairs: DataFrame,
    output_dir: str,
    shard_size: int = DEFAULT_SHARD_SIZE,
    compression: str = DEFAULT_COMPRESSION,
    id_column: str = "id",
) -> ExportResult:
    """Write `pairs` as `train-00000-of-NNNNN.parquet` and so on into `output_dir`.

    Every shard has `shard_size` rows, the last one what is left, in id order. Shards of
    an earlier export are replaced, other files stay. The new shards are written and
    counted aside first: when the job fails, the old ones are still there. A swap that was
    cut short is finished before anything else, see `finish_export`.
    """
    check_options(shard_size, compression)
    spark = pairs.sparkSession
    output_dir = output_dir.rstrip("/")
    make_folder(spark, output_dir)
    token = uuid.uuid4().hex
    staging = f"{output_dir}/_staging-{token}"
    with (
        single_writer(spark, output_dir, f"export {token}") as lease,
        engine_settings(spark),
        work_folder(spark, output_dir) as work,
    ):
        _finish(spark, output_dir)
        try:
            shards = shard_map(pairs, shard_size, work, id_column)
            for first in range(0, shards.shards, SHARDS_PER_JOB):
                last = min(first + SHARDS_PER_JOB, shards.shards) - 1
                write_shards(pairs, shards, first, last, staging, compression)
            _check_shards(spark, staging, shards)
            lease.check()
        except BaseException:
            delete_folder(spark, staging)
            raise
        # Once the plan is there, the new shards stand, whatever happens.
        plan = json.dumps({"staging": staging, "shards": shards.shards})
        write_text(spark, f"{output_dir}/{PLAN}", plan)
        _finish(spark, output_dir)
    return ExportResult(shards.stats.rows, shards.shards, output_dir)


def shard_rows(pairs: DataFrame, shards: ShardMap, first: int, last: int) -> DataFrame:
    """The exported columns of the shards `first..last`: one partition per shard, in id
    order. This is the only shuffle of whole rows."""
    assigned = shards.assign(pairs.select(shards.id_column, *EXPORT_FIELDS), first, last)
    partition = (F.col("shard") - first).cast("int")
    return (
        assigned.repartitionById(last - first + 1, partition)
        .sortWithinPartitions(shards.id_column)
        .select(*[export_column(f) for f in EXPORT_FIELDS])
    )


def export_column(name: str) -> Column:
    """The column as it is written: a field that must be there is NOT NULL in the file,
    and a NULL in it fails the export."""
    if name in NULLABLE_FIELDS:
        return F.col(name)
    empty = F.array().cast(field_type(name)) if name in LIST_FIELDS else F.lit("")
    no_value = F.raise_error(F.lit(f"NULL in required column {name}"))
    checked = F.when(F.col(name).isNull(), no_value).otherwise(F.col(name))
    return F.coalesce(checked, empty).alias(name)


def write_shards(
    pairs: DataFrame,
    shards: ShardMap,
    first: int,
    last: int,
    staging: str,
    compression: str,
) -> None:
    shard_rows(pairs, shards, first, last).write.option("compression", compression).option(
        "maxRecordsPerFile", 0
    ).parquet(f"{staging}/first={first}")


def _staged(spark: SparkSession, staging: str) -> dict[int, str]:
    """Path of every shard that lies in `staging`, by its number."""
    found = {}
    for entry in glob(spark, f"{staging}/first=*/part-*.parquet"):
        first, part = re.search(r"first=(\d+)/part-(\d+)-", entry.path).groups()
        found[int(first) + int(part)] = entry.path
    return found


def _check_shards(spark: SparkSession, staging: str, shards: ShardMap) -> None:
    """Count the rows of every shard written, from the file footers."""
    if shards.shards == 0:
        return
    counted = (
        spark.read.parquet(f"{staging}/first=*")
        .groupBy(
            F.regexp_extract("_metadata.file_path", r"first=(\d+)/", 1).alias("first"),
            F.regexp_extract("_metadata.file_name", r"part-(\d+)-", 1).alias("part"),
        )
        .count()
        .collect()
    )
    rows = {int(r["first"]) + int(r["part"]): r["count"] for r in counted}
    expected = {k: shards.rows_in(k) for k in range(shards.shards)}
    if rows != expected or _staged(spark, staging).keys() != expected.keys():
        raise RuntimeError(
            f"shards do not add up; is {shards.id_column} unique in the exported table?"
        )


def finish_export(spark: SparkSession, output_dir: str) -> bool:
    """Finish the swap of an export that was cut short in it; whether there was one."""
    output_dir = output_dir.rstrip("/")
    with single_writer(spark, output_dir, f"export {uuid.uuid4().hex}"):
        return _finish(spark, output_dir)


def _finish(spark: SparkSession, output_dir: str) -> bool:
    """Carry out the plan in `output_dir`, if there is one. It may be run again at any point.

    A staged shard has not been moved yet, so what has its name is old, as is every shard
    that is not of the plan. All old shards go before the first new one comes, and no reader
    meets both. The plan goes last.
    """
    path, plan = f"{output_dir}/{PLAN}", None
    if path_exists(spark, path):
        try:
            plan = json.loads(read_text(spark, path))
        except ValueError:
            # Cut short itself, so nothing has been moved yet.
            delete_file(spark, path)
    for entry in glob(spark, f"{output_dir}/_staging-*"):
        if plan is None or entry.name != plan["staging"].rpartition("/")[2]:
            delete_folder(spark, entry.path)
    if plan is None:
        return False
    count, staged = plan["shards"], _staged(spark, plan["staging"])
    name = "train-{:05d}-of-{:05d}.parquet".format
    moved = {name(k, count) for k in range(count) if k not in staged}
    there = {
        e.name: e.path
        for e in list_folder(spark, output_dir)
        if e.is_file and e.name.startswith("train-") and e.name.endswith(".parquet")
    }
    if not moved <= there.keys():
        raise RuntimeError(f"{path} names shards that are nowhere; nothing was deleted")
    old = [there[n] for n in there if n not in moved]
    _at_once(lambda path: delete_file(spark, path), old)
    _at_once(
        lambda k: rename_file(spark, staged[k], f"{output_dir}/{name(k, count)}"), staged
    )
    delete_folder(spark, plan["staging"])
    delete_file(spark, path)
    return True


def _at_once(action: Callable, items: Iterable) -> None:
    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        list(pool.map(action, items))
