"""The collection: a folder of Parquet batches, one per load.

    <store>/first_id=<n>/load_id=<name>/part-*.parquet, _SUCCESS
    <store>/_merged/from=<n>/to=<n>/part-*.parquet, _loads, _SUCCESS
    <store>/_rejects/load_id=<name>/part-*.parquet
    <store>/_keys/from=<n>/to=<n>/keys=<k>/buckets=<B>/bucket=<b>/part-*.parquet

A batch belongs to the collection once Spark has put its `_SUCCESS` marker there, so a
load is visible as a whole or not at all, on object stores as well, and no file is ever
moved or rewritten. A batch left without the marker by a lost driver is never read.

Many small batches are compacted into one that stands for a run of them, from the first
one's `first_id` to the last one's. It counts once its own marker is there, and from then
on the batches inside its run do not; ids, and so exports, stay as they were.

The keys of all loads are kept in segments, each for a run of batches, in buckets by hash
and sorted by hash inside. Whenever the newest segments are `MERGE_AT` of one size, they
become one of the next, so n loads leave some log n segments; a batch too small for a
segment counts as one until then and is looked up in its own key column. A load reads the
buckets and row groups that its own keys fall into. Segments only speed up the look-up:
batches without one, as after a crash, are read themselves.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.schema import LIST_FIELDS, RECORD_FIELDS, STORE_SCHEMA
from pairloom.session import engine_settings
from pairloom.sources.folders import (
    MARKER,
    WITH_MARKER,
    WITHOUT_MARKER,
    Lease,
    check_marked,
    delete_folder,
    glob,
    make_folder,
    path_exists,
    read_text,
    scan_uri,
    single_writer,
    write_text,
)

LOAD_ID = re.compile(r"[A-Za-z0-9._-]+")
# Numbers of buckets are powers of two, so one hash modulo the largest gives them all.
MOST_BUCKETS = 4096
KEYS_PER_BUCKET = 500_000
MERGE_AT = 8
# Segments of fewer keys are of one size.
SMALLEST_SIZE = 1000
# Rows a compacted batch may have, and rows and bytes of text of one of its files.
COMPACTED_ROWS = 1_000_000
ROWS_PER_FILE = 250_000
BYTES_PER_FILE = 128 * 2**20


def key_bucket(key: str, buckets: int = MOST_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Batch:
    """One load's rows, or those of a run of loads, `first_id` to `last_first_id`."""

    first_id: int
    last_first_id: int
    path: str

    @property
    def merged(self) -> bool:
        return "/_merged/" in self.path


@dataclass(frozen=True)
class KeySegment:
    """Keys of the batches in a run; `buckets` is 0 for a batch that is read itself."""

    first: int
    last: int
    path: str
    keys: int = 0
    buckets: int = 0

    @property
    def size(self) -> int:
        """Which of the sizes, each `MERGE_AT` times the one before, it has."""
        size, most = 0, SMALLEST_SIZE
        while self.keys > most:
            size, most = size + 1, most * MERGE_AT
        return size


def covering(runs: list, first: str, last: str, overlap: bool) -> list:
    """Of runs that lie inside or beside one another, the widest that take in all of them.

    With `overlap`, runs may cut into each other; then all that add something are kept.
    """
    kept, reached = [], -1
    for run in sorted(runs, key=lambda r: (getattr(r, first), -getattr(r, last))):
        if getattr(run, last if overlap else first) > reached:
            kept.append(run)
            reached = max(reached, getattr(run, last))
    return kept


class PairStore:
    """Where the pairs are kept. There is one writer at a time and any number of readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def create(self) -> None:
        """Create the empty collection unless there is one already."""
        make_folder(self.spark, self.path)

    def _plain(self) -> list[tuple[Batch, str]]:
        found = []
        for marker in glob(self.spark, f"{self.path}/first_id=*/load_id=*/{MARKER}"):
            folder = marker.path.removesuffix(f"/{MARKER}")
            first, load = folder.rsplit("/", 2)[-2:]
            first_id = int(first.removeprefix("first_id="))
            found.append((Batch(first_id, first_id, folder), load.removeprefix("load_id=")))
        return found

    def _compacted(self) -> list[Batch]:
        found = []
        for marker in glob(self.spark, f"{self.path}/_merged/from=*/to=*/{MARKER}"):
            folder = marker.path.removesuffix(f"/{MARKER}")
            first, last = (int(part.partition("=")[2]) for part in folder.rsplit("/", 2)[-2:])
            found.append(Batch(first, last, folder))
        return found

    def batches(self) -> list[Batch]:
        """The committed batches, oldest first; a compacted one in place of its run."""
        found = self._compacted() + [batch for batch, _ in self._plain()]
        return covering(found, "first_id", "last_first_id", overlap=False)

    def read(self) -> DataFrame:
        """All stored pairs with their `id`; rows come in no particular order."""
        if not self.exists():
            raise FileNotFoundError(f"no pair store at {self.path}")
        return self._read(self.batches())

    def read_batches(self, batches: list[Batch]) -> DataFrame:
        """The pairs of some of the `batches`."""
        return self._read(batches)

    def _read(self, batches: list[Batch]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], STORE_SCHEMA)
        return self.spark.read.schema(STORE_SCHEMA).parquet(*[b.path for b in batches])

    def last_id(self) -> int:
        """Highest id given out. Ids grow from batch to batch, so only the newest one's
        id column is read."""
        newest = self.batches()[-1:]
        if not newest:
            return 0
        return self._read(newest).agg(F.max("id")).first()[0]

    def has_load(self, load_id: str) -> bool:
        if any(load == load_id for _, load in self._plain()):
            return True
        lists = (read_text(self.spark, f"{b.path}/_loads") for b in self._compacted())
        return any(load_id in loads.split("\n") for loads in lists)

    def key_segments(self) -> list[KeySegment]:
        """What a look-up reads, oldest first: segments, and batches that are in none."""
        batches = self.batches()
        starts, ends = {b.first_id for b in batches}, {b.last_first_id for b in batches}
        found = [KeySegment(b.first_id, b.last_first_id, b.path) for b in batches]
        pattern = f"{self.path}/_keys/from=*/to=*/keys=*/buckets=*/{MARKER}"
        for marker in glob(self.spark, pattern):
            folder = marker.path.removesuffix(f"/{MARKER}")
            first, last, keys, buckets = (
                int(part.partition("=")[2]) for part in folder.rsplit("/", 4)[-4:]
            )
            if first in starts and last in ends:
                found.append(KeySegment(first, last, folder, keys, buckets))
        # Of equal runs the segment comes before the batch itself.
        found.sort(key=lambda s: -s.buckets)
        return covering(found, "first", "last", overlap=True)

    def keys(self, buckets: list[int], hashes: tuple[int, int] | None = None) -> DataFrame:
        """`(task_id)` of every stored pair whose `key_bucket` is among `buckets` and whose
        hash is within `hashes`, and of the batches that are in no segment."""
        parts: dict[int, list[str]] = {}
        for segment in self.key_segments():
            parts.setdefault(segment.buckets, []).append(segment.path)
        raw = [Batch(0, 0, path) for path in parts.pop(0, [])]
        found = self._read(raw).select("task_id")
        for n, folders in parts.items():
            wanted = sorted({b % n for b in buckets})
            kept = self._segment_keys(folders).where(F.col("bucket").isin(wanted))
            if hashes:
                kept = kept.where(F.col("hash").between(*hashes))
            found = found.unionByName(kept.select("task_id"))
        return found

    def _segment_keys(self, folders: list[str]) -> DataFrame:
        """Segments side by side; each folder's `bucket` is a column."""
        schema = "task_id string, hash long, bucket int"
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/_keys")
        return reader.parquet(*folders)

    def merge_keys(self, newest_rows: int = 0) -> None:
        """Give the newest batch a segment if it is large, and merge segments of one size.

        A merge is a segment for a longer run beside the old ones, which are deleted once
        it is committed. So a key is written again once a size, not once a load.
        """
        segments = self.key_segments()
        if segments and not segments[-1].buckets and newest_rows >= 2 * KEYS_PER_BUCKET:
            segments[-1:] = [self._write_segment(segments[-1:])]
        while True:
            newest = segments[-MERGE_AT:]
            if len(newest) < MERGE_AT or len({s.size for s in newest}) > 1:
                return
            segments[-MERGE_AT:] = [self._write_segment(newest)]

    def _write_segment(self, parts: list[KeySegment]) -> KeySegment:
        """One segment of all keys in `parts`, which follow one another."""
        folders = [s.path for s in parts if s.buckets]
        raw = [Batch(s.first, s.last, s.path) for s in parts if not s.buckets]
        rows = self._read(raw).select("task_id")
        if folders:
            rows = rows.unionByName(self._segment_keys(folders).select("task_id"))
        # Runs may cut into each other where batches were compacted in between.
        rows = rows.distinct() if len(parts) > 1 else rows
        n, buckets = rows.count(), 1
        while buckets < MOST_BUCKETS and 2 * buckets * KEYS_PER_BUCKET <= n:
            buckets *= 2
        first, last = min(s.first for s in parts), max(s.last for s in parts)
        folder = f"{self.path}/_keys/from={first:020d}/to={last:020d}/keys={n}/buckets={buckets}"
        hashed = rows.select("task_id", F.xxhash64("task_id").alias("hash"))
        hashed = hashed.withColumn("bucket", key_bucket("task_id", buckets))
        hashed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "hash").write.mode(
            "overwrite"
        ).partitionBy("bucket").options(**WITH_MARKER).parquet(folder)
        check_marked(self.spark, folder)
        for old in folders:
            if old != folder:
                delete_folder(self.spark, old)
        return KeySegment(first, last, folder, n, buckets)

    def compact(self, most_rows: int | None = None, owner: str = "compaction") -> int:
        """Join neighbouring batches of together up to `most_rows` rows; how many were.

        Ids and contents stay. The old batches stay too, unread, for readers that began
        before; `drop_compacted` deletes them.
        """
        most_rows = most_rows or COMPACTED_ROWS
        with single_writer(self.spark, self.path, owner), engine_settings(self.spark):
            batches = self.batches()
            if len(batches) < 2:
                return 0
            sizes = self._rows_of(batches)
            runs, held = [], 0
            for batch in batches:
                if not runs or held + sizes[batch.path] > most_rows:
                    runs, held = [*runs, []], 0
                runs[-1].append(batch)
                held += sizes[batch.path]
            runs = [run for run in runs if len(run) > 1]
            for run in runs:
                self._write_run(run, sum(sizes[b.path] for b in run))
            return sum(map(len, runs))

    def _rows_of(self, batches: list[Batch]) -> dict[str, int]:
        """Rows of each batch, from the footers, in one job."""
        folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
        counted = self._read(batches).groupBy(folder.alias("folder")).count().collect()
        rows = {r["folder"]: r["count"] for r in counted}
        return {b.path: rows.get(scan_uri(self.spark, b.path).rstrip("/"), 0) for b in batches}

    def _text_bytes(self, batches: list[Batch]) -> int:
        """Bytes of the rows' texts, lists as JSON."""
        held = [
            F.octet_length(F.to_json(name) if name in LIST_FIELDS else F.col(name))
            for name in RECORD_FIELDS
        ]
        sizes = [F.sum(size) for size in held]
        return sum(size or 0 for size in self._read(batches).agg(*sizes).first())

    def _write_run(self, run: list[Batch], rows: int) -> None:
        first, last = run[0].first_id, run[-1].last_first_id
        folder = f"{self.path}/_merged/from={first:020d}/to={last:020d}"
        loads = [load for batch, load in self._plain() if first <= batch.first_id <= last]
        for batch in run:
            if batch.merged:
                loads += read_text(self.spark, f"{batch.path}/_loads").split("\n")
        delete_folder(self.spark, folder)
        make_folder(self.spark, folder)
        write_text(self.spark, f"{folder}/_loads", "\n".join(sorted(set(loads))))
        ranges = max(1, -(-rows // ROWS_PER_FILE), -(-self._text_bytes(run) // BYTES_PER_FILE))
        self._read(run).repartitionByRange(ranges, "id").sortWithinPartitions("id").write.mode(
            "append"
        ).option("compression", "zstd").options(**WITH_MARKER).parquet(folder)
        check_marked(self.spark, folder)
        self._write_segment([KeySegment(first, last, folder)])

    def drop_compacted(self) -> int:
        """Delete the batches that a compacted one stands for; how many there were."""
        kept = {b.path for b in self.batches()}
        every = self._compacted() + [batch for batch, _ in self._plain()]
        old = [b.path for b in every if b.path not in kept]
        for path in old:
            delete_folder(self.spark, path)
        return len(old)

    def append(
        self,
        rows: DataFrame,
        first_id: int,
        load_id: str,
        n_rows: int,
        lease: Lease | None = None,
    ) -> None:
        """Write one batch of `n_rows` whose ids are all >= `first_id`, above every id given
        out. With a `lease`, the batch is committed only while that is held."""
        check_load_id(load_id)
        folder = f"{self.path}/first_id={first_id:020d}/load_id={load_id}"
        rows.select(*STORE_SCHEMA.names).write.mode("overwrite").option(
            "compression", "zstd"
        ).options(**(WITHOUT_MARKER if lease else WITH_MARKER)).parquet(folder)
        if lease:
            lease.check()
            write_text(self.spark, f"{folder}/{MARKER}", "")
        check_marked(self.spark, folder)
        self.merge_keys(n_rows)

    def rejects_path(self, load_id: str) -> str:
        return f"{self.path}/_rejects/load_id={check_load_id(load_id)}"


def table_exists(spark: SparkSession, name: str) -> bool:
    """The same probe for a collection kept as a catalog table."""
    return spark.catalog.tableExists(name)


def check_load_id(load_id: str) -> str:
    if not LOAD_ID.fullmatch(load_id):
        raise ValueError(f"a load id may hold letters, digits, '.', '_', '-': {load_id!r}")
    return load_id
