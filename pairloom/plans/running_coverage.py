"""Coverage that reads each batch of a store once, however often it is reported.

    <store>/_counts/from=<n>/to=<n>/part-*.parquet, _SUCCESS

Batches never change, so their counts stay true. A report reads the counts kept for runs of
batches, counts the batches that are in none, and keeps these too; once there are `MERGE_AT`
kept tables they become one. Each has a row per distinct value, whatever the rows counted.

A compacted batch has the rows of its run, so kept counts hold after compaction as long as
their run begins and ends where a batch does. Others are left out, and their rows counted
anew. Kept counts only save reading: without any, the result is the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pairloom.operators.coverage import added_parts, coverage_parts, named_parts
from pairloom.sources.folders import (
    MARKER,
    WITH_MARKER,
    check_marked,
    delete_folder,
    glob,
    make_folder,
    single_writer,
)
from pairloom.sources.pair_store import Batch, PairStore, covering

SCHEMA = "axis string, a string, b string, n long"
MERGE_AT = 16


@dataclass(frozen=True)
class Counted:
    """Kept counts of the batches from `first` to `last`."""

    first: int
    last: int
    path: str


def kept_counts(store: PairStore, batches: list[Batch]) -> list[Counted]:
    """The kept counts that hold for `batches`, oldest first; no two share a batch."""
    starts, ends = {b.first_id for b in batches}, {b.last_first_id for b in batches}
    found = []
    for marker in glob(store.spark, f"{store.path}/_counts/from=*/to=*/{MARKER}"):
        folder = marker.path.removesuffix(f"/{MARKER}")
        first, last = (int(part.partition("=")[2]) for part in folder.rsplit("/", 2)[-2:])
        if first in starts and last in ends:
            found.append(Counted(first, last, folder))
    return covering(found, "first", "last", overlap=False)


def uncounted_runs(batches: list[Batch], kept: list[Counted]) -> list[list[Batch]]:
    """The batches in no kept run, in stretches that no kept run interrupts."""
    runs: list[list[Batch]] = []
    reached = None
    for batch in batches:
        before = sum(k.last < batch.first_id for k in kept)
        if any(k.first <= batch.first_id <= k.last for k in kept):
            continue
        if before != reached or not runs:
            runs.append([])
        runs[-1].append(batch)
        reached = before
    return runs


def running_coverage(store: PairStore) -> DataFrame:
    """`(axis, key, n)` of a whole store, like `coverage_long` of its rows.

    One report at a time may run; loads may go on meanwhile, and count from the next one.
    """
    if not store.exists():
        raise FileNotFoundError(f"no pair store at {store.path}")
    spark, folder = store.spark, f"{store.path}/_counts"
    make_folder(spark, folder)
    with single_writer(spark, folder, "coverage") as lease:
        batches = store.batches()
        kept = kept_counts(store, batches)
        for run in uncounted_runs(batches, kept):
            parts = coverage_parts(store.read_batches(run))
            kept.append(_keep(store, run[0].first_id, run[-1].last_first_id, parts))
        if len(kept) >= MERGE_AT:
            lease.check()
            kept = [_merge(store, sorted(kept, key=lambda k: k.first))]
    # The result is small and outlives its folders, which a later report may merge.
    rows = added_parts(_read(store, kept)).collect()
    return named_parts(spark.createDataFrame(rows, SCHEMA))


def _read(store: PairStore, kept: list[Counted]) -> DataFrame:
    if not kept:
        return store.spark.createDataFrame([], SCHEMA)
    return store.spark.read.schema(SCHEMA).parquet(*[k.path for k in kept])


def _keep(store: PairStore, first: int, last: int, parts: DataFrame) -> Counted:
    folder = f"{store.path}/_counts/from={first:020d}/to={last:020d}"
    parts.coalesce(1).write.mode("overwrite").options(**WITH_MARKER).parquet(folder)
    check_marked(store.spark, folder)
    return Counted(first, last, folder)


def _merge(store: PairStore, kept: list[Counted]) -> Counted:
    """All kept counts as one, beside the old ones, which are deleted once it is there."""
    merged = _keep(store, kept[0].first, kept[-1].last, added_parts(_read(store, kept)))
    for old in kept:
        if old.path != merged.path:
            delete_folder(store.spark, old.path)
    return merged
