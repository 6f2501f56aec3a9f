"""Pick up new record files as they arrive and load each of them once."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.plans.load import LoadResult, load_files, load_lines
from pairloom.session import work_folder, written
from pairloom.sources.change_log import ChangeLog, FileChange, files_in
from pairloom.sources.folders import (
    list_folder,
    make_folder,
    path_exists,
    read_text,
    single_writer,
    write_text,
)
from pairloom.sources.jsonl import line_columns, no_records, number_in_task
from pairloom.sources.pair_store import PairStore
from pairloom.taxonomy import TAXONOMY, Taxonomy


def stream_lines(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files that appear in `folder`, with the place they come from."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder).select(*line_columns())


def start_load_stream(
    spark: SparkSession,
    folder: str,
    store: PairStore,
    checkpoint: str,
    max_files_per_trigger: int | None = 1000,
    processing_time: str | None = None,
    taxonomy: Taxonomy = TAXONOMY,
    on_result: Callable[[LoadResult], None] | None = None,
) -> StreamingQuery:
    """Start loading; by default everything there is, then stop (the scheduled run).

    With `processing_time` (`"1 hour"`) the query keeps running instead. The store is the
    state: a record delivered again is skipped however old it is, and nothing grows in
    the stream. Files that Spark passes over for their names are loaded after the others, see
    `_load_hidden`. Spark takes files by age; so are those of one micro-batch read, and then by
    name. A path is taken once: for files that are rewritten see `load_arrivals`. Each micro-batch is one load named after the checkpoint and the batch
    number, so a batch replayed after a crash is not stored twice. Spark allows one
    running query per checkpoint.
    """
    store.create()
    stream_id = _stream_id(spark, checkpoint)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        result = load_lines(
            batch.sparkSession,
            number_in_task(batch),
            None,
            store,
            f"{stream_id}-{batch_id}",
            taxonomy,
            owner=f"stream {stream_id}",
        )
        if on_result:
            on_result(result)
        _load_hidden(batch.sparkSession, folder, store, checkpoint, taxonomy, on_result)

    writer = (
        stream_lines(spark, folder, max_files_per_trigger)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
    )
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()


def _load_hidden(
    spark: SparkSession,
    folder: str,
    store: PairStore,
    checkpoint: str,
    taxonomy: Taxonomy = TAXONOMY,
    on_result: Callable[[LoadResult], None] | None = None,
) -> None:
    """Load the files that Spark's stream passes over for their names, each path once.

    Names that begin with `_` or `.` are taken if they end in `.jsonl`; other names of that
    kind, as writers give to what is not finished, are reported as `ignored`, each once.
    Each is a load of its own with a mark in the checkpoint, written after it.
    """
    stream_id, passed_over = _stream_id(spark, checkpoint), []
    names = {e.name for e in list_folder(spark, folder)}
    for entry in list_folder(spark, folder):
        if not entry.is_file or not entry.name.startswith(("_", ".")):
            continue
        path_id = hashlib.sha256(entry.path.encode()).hexdigest()
        mark = f"{checkpoint}/hidden/{path_id}"
        if no_records(names, entry.name) or path_exists(spark, mark):
            continue
        if entry.name.endswith(".jsonl"):
            load_id = f"{stream_id}-{path_id}"
            owner = f"stream {stream_id}"
            result = load_files(spark, [entry.path], store, load_id, taxonomy, owner=owner)
            if on_result:
                on_result(result)
        else:
            passed_over.append(entry.path)
        make_folder(spark, f"{checkpoint}/hidden")
        write_text(spark, mark, entry.path)
    if passed_over and on_result:
        on_result(LoadResult(f"{stream_id}-ignored", ignored=passed_over))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name kept with the checkpoint: the same after a restart, new for a new one."""
    path = f"{checkpoint}/load_stream_id"
    if not path_exists(spark, path):
        make_folder(spark, checkpoint)
        write_text(spark, path, uuid.uuid4().hex, overwrite=False)
    return read_text(spark, path)


def load_arrivals(
    spark: SparkSession,
    folder: str,
    store: PairStore,
    log: str,
    max_files: int = 1000,
    taxonomy: Taxonomy = TAXONOMY,
) -> list[LoadResult]:
    """One scheduled run over a folder whose files may be written again under their names.

    A file is loaded if its time or size is not the one in the log (`ChangeLog`), that is
    also after it was rewritten; the store skips records it has. Files go by time and then by
    name, and in loads of `max_files`, which does not change what is stored; the driver
    knows those of one load only. Each load is written to the log as a plan before and as
    done after, under one number; a run that finds a plan that is not done repeats it under
    the same load id, so a crash neither loses nor doubles a file. One run at a time holds
    the log. Files that are none of records by their names are `ignored` in the first
    result, if anything was loaded.
    """
    store.create()
    make_folder(spark, log)
    stream_id = _stream_id(spark, log)
    name = f"arrivals {stream_id}"
    changes, results, ignored = ChangeLog(spark, log), [], []

    def run(number: int, files: list[FileChange]) -> None:
        paths = [path for path, _, _ in files]
        results.append(
            load_files(spark, paths, store, f"{stream_id}-{number}", taxonomy, owner=name)
        )
        write_text(spark, changes.done_path(number), "")

    with single_writer(spark, log, name) as lease, work_folder(spark, log) as work:
        number = changes.last()
        if (unfinished := changes.unfinished()) is not None:
            run(unfinished, changes.files_of(unfinished))
        fresh = changes.changed(files_in(spark, folder, ignored))
        fresh, last = written(fresh, f"{work}/fresh"), None
        while True:
            order, rest = F.struct("modified", "path"), fresh
            if last:
                # The first condition alone reaches the scan's statistics.
                after = F.struct(F.lit(last[1]).alias("modified"), F.lit(last[0]).alias("path"))
                rest = fresh.where((F.col("modified") >= last[1]) & (order > after))
            files = [tuple(f) for f in rest.orderBy("modified", "path").limit(max_files).collect()]
            if not files:
                break
            last, number = files[-1], number + 1
            lease.check()
            changes.plan(number, files)
            run(number, files)
            changes.shorten()
    if results:
        results[0].ignored += ignored
    return results


def load_stream(
    spark: SparkSession, folder: str, store: PairStore, checkpoint: str, **options
) -> list[LoadResult]:
    """One scheduled run: load what has arrived since the last one and return."""
    results: list[LoadResult] = []
    query = start_load_stream(
        spark, folder, store, checkpoint, on_result=results.append, **options
    )
    query.awaitTermination()
    taxonomy = options.get("taxonomy", TAXONOMY)
    _load_hidden(spark, folder, store, checkpoint, taxonomy, results.append)
    return results
