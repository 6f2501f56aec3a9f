"""Loading files into a store: accounting, order, first wins, replays, rejects."""

import json
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pairloom.operators import new_keys, numbering
from pairloom.plans.load import RecordsFailed, load_files, rejected_records
from pairloom.sources.folders import WriterBusy
from pairloom.schema import STORE_SCHEMA
from pairloom.sources.pair_store import PairStore, table_exists
from tests.records import line, record, without, write_file


@pytest.fixture
def store(spark, tmp_path):
    return PairStore(spark, str(tmp_path / "store"))


def ids_in_order(store):
    return [r.task_id for r in store.read().orderBy("id").collect()]


def counts(result):
    return result.inserted, result.skipped, result.failed


def test_good_bad_blank_and_duplicate_lines(spark, tmp_path, store):
    values = [record("a"), "", "   ", "{bad", record("b"), record("a"), without("plan", "c")]
    result = load_files(spark, [write_file(tmp_path / "f.jsonl", values)], store)
    assert counts(result) == (2, 1, 2)
    assert result.summary() == "total: inserted=2 skipped=1 failed=2"
    assert ids_in_order(store) == ["a", "b"]
    row = store.read().where("task_id = 'a'").first()
    assert row.capability_tags == ["reasoning"] and row.references is None
    assert row.created_at is not None


def test_ids_of_a_clean_load_count_up(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record(t) for t in "abc"])
    load_files(spark, [path], store)
    load_files(spark, [write_file(tmp_path / "g.jsonl", [record("d")])], store)
    rows = store.read().orderBy("id").select("id", "task_id").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_no_paths(spark, store):
    with pytest.raises(ValueError, match="at least one"):
        load_files(spark, [], store)


def test_missing_file_is_reported_and_the_store_is_created(spark, tmp_path, store):
    result = load_files(spark, [str(tmp_path / "none.jsonl")], store)
    assert [f.status for f in result.files] == ["missing"]
    assert counts(result) == (0, 0, 0)
    assert store.exists() and store.read().count() == 0


def test_missing_empty_and_present_files_in_order(spark, tmp_path, store):
    paths = [
        str(tmp_path / "none.jsonl"),
        write_file(tmp_path / "z.jsonl", [record("z"), record("both", context="z")]),
        write_file(tmp_path / "empty.jsonl", []),
        write_file(tmp_path / "a.jsonl", [record("both", context="a"), record("a"), "x"]),
    ]
    result = load_files(spark, paths, store)
    assert [(f.status, f.inserted, f.skipped, f.failed) for f in result.files] == [
        ("missing", 0, 0, 0),
        ("loaded", 2, 0, 0),
        ("loaded", 0, 0, 0),
        ("loaded", 1, 1, 1),
    ]
    assert [f.path for f in result.files] == paths
    assert ids_in_order(store) == ["z", "both", "a"]
    assert store.read().where("task_id = 'both'").first().context == "z"


def test_same_file_twice(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), record("b"), "x"])
    result = load_files(spark, [path, path], store)
    assert [(f.inserted, f.skipped, f.failed) for f in result.files] == [(2, 0, 1), (0, 2, 1)]


def test_folder_and_odd_file_names(spark, tmp_path, store):
    folder = tmp_path / "in put"
    folder.mkdir()
    names = ["a b%20.jsonl", "b[1]*?{x}.jsonl", "c#ä.jsonl", "_hidden", ".dot"]
    for name in names:
        write_file(folder / name, [record(name)])
    (folder / "sub").mkdir()
    result = load_files(spark, [str(folder)], store)
    assert counts(result) == (5, 0, 0)
    assert ids_in_order(store) == sorted(names)
    assert {f.path.rpartition("/")[2] for f in result.files if f.status == "folder"} == {"sub"}
    again = [str(folder / name) for name in ("_hidden", "_hidden", ".dot", "none")]
    result = load_files(spark, again, store)
    assert [(f.status, f.skipped) for f in result.files] == [
        ("loaded", 1), ("loaded", 1), ("loaded", 1), ("missing", 0)
    ]


def test_order_over_many_splits(spark, tmp_path, store):
    one = write_file(tmp_path / "one.jsonl", [record(f"t{i:04d}") for i in range(300)])
    two = write_file(
        tmp_path / "two.jsonl",
        [record(f"t{i:04d}", context="second") for i in range(250, 400)],
    )
    bad = tmp_path / "bad.jsonl"
    write_file(bad, ["" if i % 3 else f"bad {i}" for i in range(500)])
    with small_splits(spark):
        result = load_files(spark, [one, two, str(bad)], store, load_id="x")
    assert counts(result) == (400, 50, 167)
    assert ids_in_order(store) == [f"t{i:04d}" for i in range(400)]
    assert store.read().where("context = 'second'").count() == 100
    rejects = rejected_records(spark, store, "x").orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in rejects] == [
        (i + 1, f"bad {i}") for i in range(0, 500, 3)
    ]
    assert all(r.file_path.endswith("/bad.jsonl") for r in rejects)


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_splits(spark):
    return setting(spark, "spark.sql.files.maxPartitionBytes", "4096")


@pytest.fixture
def own_choice_of_joins(spark):
    """Broadcast only where the library asks for it, as with tables of a real size."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


@pytest.mark.parametrize("limit, span", [(0, 0), (0, 10**9), (10**9, 10**9)])
def test_all_join_paths_agree(
    spark, tmp_path, store, monkeypatch, own_choice_of_joins, limit, span
):
    monkeypatch.setattr(new_keys, "LINES_TO_BROADCAST", limit)
    monkeypatch.setattr(new_keys, "SPAN_TO_BROADCAST", span)
    monkeypatch.setattr(numbering, "SPLITS_TO_BROADCAST", limit)
    monkeypatch.setattr(numbering, "FILES_TO_BROADCAST", limit)
    monkeypatch.setattr("pairloom.plans.load.KEY_BYTES_TO_BROADCAST", limit)
    first = write_file(tmp_path / "a.jsonl", [record(f"t{i}") for i in range(0, 60, 2)])
    load_files(spark, [first], store)
    # A third of the lines carry one key; most of the rest is stored already.
    values = [record("hot" if i % 3 == 0 else f"t{i}", context=str(i)) for i in range(90)]
    result = load_files(spark, [write_file(tmp_path / "b.jsonl", values)], store)
    stored = {f"t{i}" for i in range(0, 60, 2)}
    new = {v["task_id"] for v in values} - stored
    assert counts(result) == (len(new), 90 - len(new), 0)
    assert set(ids_in_order(store)) == stored | new
    assert store.read().where("task_id = 'hot'").first().context == "0"
    again = load_files(spark, [first], store)
    assert counts(again) == (0, 30, 0)
    few = [record("n1"), record("n1"), record("t2"), *[record(f"m{i}") for i in range(9)]]
    result = load_files(spark, [write_file(tmp_path / "c.jsonl", few)], store)
    assert counts(result) == (10, 2, 0)


def test_only_valid_records_claim_a_key(spark, tmp_path, store):
    values = [record("a", domain="other"), record("a", context="good"), record("a", plan=1)]
    result = load_files(spark, [write_file(tmp_path / "f.jsonl", values)], store)
    assert counts(result) == (1, 0, 2)
    assert store.read().first().context == "good"


def test_long_record_is_loaded_and_over_long_line_ends_its_file(spark, tmp_path, store):
    limit = 10 << 20
    shell = len(line(record("edge", final_answer="")))
    values = [
        record("big", final_answer="A" * ((1 << 20) + 1)),
        record("edge", final_answer="B" * (limit - 1 - shell)),
        "x",
        record("over", final_answer="C" * (limit - shell)),
        record("after"),
        "y",
        "z" * (limit + 1),
    ]
    cut = write_file(tmp_path / "cut.jsonl", values)
    fine = write_file(tmp_path / "fine.jsonl", [record("other"), record("big")])
    result = load_files(spark, [cut, fine], store, load_id="x")
    assert [(f.status, f.inserted, f.skipped, f.failed) for f in result.files] == [
        ("error", 2, 0, 1),
        ("loaded", 1, 1, 0),
    ]
    assert counts(result) == (1, 1, 0)
    assert ids_in_order(store) == ["big", "edge", "other"]
    assert [r.value for r in rejected_records(spark, store, "x").collect()] == ["x"]


def test_carriage_returns(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), record("b")], end="\r\n")
    lone = tmp_path / "lone.jsonl"
    lone.write_bytes((line(record("c")) + "\r" + line(record("d"))).encode())
    result = load_files(spark, [path, str(lone)], store)
    assert counts(result) == (2, 0, 1)


def test_reload_and_replay(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), record("b")])
    load_files(spark, [path], store, load_id="one")
    replay = load_files(spark, [path], store, load_id="one")
    assert replay.replayed and counts(replay) == (0, 0, 0)
    again = load_files(spark, [path], store, load_id="two")
    assert not again.replayed and counts(again) == (0, 2, 0)
    assert store.read().count() == 2 and len(store.batches()) == 1


def test_a_batch_without_marker_does_not_count(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), record("b")])
    load_files(spark, [path], store, load_id="one")
    (marker,) = (tmp_path / "store").glob("first_id=*/load_id=one/_SUCCESS")
    marker.unlink()
    assert store.read().count() == 0 and store.last_id() == 0
    result = load_files(spark, [path], store, load_id="one")
    assert counts(result) == (2, 0, 0) and store.read().count() == 2


def test_failed_records_raise_after_the_commit(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), "x"])
    with pytest.raises(RecordsFailed, match="1 record") as error:
        load_files(spark, [path], store, raise_on_failed=True)
    assert counts(error.value.result) == (1, 0, 1)
    assert ids_in_order(store) == ["a"]


def test_rejects_name_file_line_stage_and_element(spark, tmp_path, store):
    values = ["", "{", record(), record(plan=["a", 1]), record(domain="x"), without("plan")]
    path = write_file(tmp_path / "f.jsonl", values)
    load_files(spark, [path], store, load_id="x")
    rows = rejected_records(spark, store, "x").orderBy("line_no").collect()
    assert [(r.line_no, r.stage, r.reason, r.element) for r in rows] == [
        (2, "json", "json", None),
        (4, "field", "type:plan", 1),
        (5, "enum", "enum:domain", None),
        (6, "field", "missing:plan", None),
    ]
    assert json.loads(rows[1].value)["plan"] == ["a", 1]
    assert rejected_records(spark, store, "none").count() == 0


def test_one_writer_at_a_time(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a")])
    store.create()
    (tmp_path / "store" / "_writer").write_text("someone else")
    with pytest.raises(WriterBusy, match="someone else"):
        load_files(spark, [path], store)
    (tmp_path / "store" / "_writer").unlink()
    assert load_files(spark, [path], store).inserted == 1
    assert not (tmp_path / "store" / "_writer").exists()


def test_session_settings_are_put_back(spark, tmp_path, store):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        load_files(spark, [write_file(tmp_path / "f.jsonl", [record("a")])], store)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_ids_are_safe_as_folder_names(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a")])
    with pytest.raises(ValueError, match="load id"):
        load_files(spark, [path], store, load_id="../x")


def test_missing_store(spark, tmp_path):
    store = PairStore(spark, str(tmp_path / "none"))
    assert not store.exists()
    with pytest.raises(FileNotFoundError):
        store.read()
    assert not table_exists(spark, "no_such_table")


def test_new_line_narrow_read(spark, tmp_path, store):
    """Finding new keys reads the key column of the store and nothing else."""
    load_files(spark, [write_file(tmp_path / "f.jsonl", [record("a")])], store)
    first = spark.createDataFrame([("b", 0, 0)], "task_id string, line long, file_ord int")
    for small in (True, False):
        found = new_keys.not_stored(first, store.read(), small=small)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<task_id:string>" in plan
        assert found.count() == 1
    hot = spark.range(1000).select(
        F.lit("k").alias("task_id"), F.col("id").alias("line"), F.lit(0).alias("file_ord")
    )
    plan = new_keys.first_of_each(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("lines, span", [(0, 0), (0, 10**9), (10**9, 10**9)])
@pytest.mark.parametrize("kept", ["line % 3 = 0", "line % 3 > 0", "line < 32768", "line = 99999"])
def test_keep_lines_over_many_runs(spark, monkeypatch, own_choice_of_joins, lines, span, kept):
    monkeypatch.setattr(new_keys, "LINES_TO_BROADCAST", lines)
    monkeypatch.setattr(new_keys, "SPAN_TO_BROADCAST", span)
    rows = spark.range(0, 100_000).select(F.col("id").alias("line"), F.lit("x").alias("x"))
    wanted = rows.where(kept)
    found = new_keys.keep_lines(rows, wanted, wanted.count(), 100_000, 100_000)
    assert found.columns == ["line", "x"]
    assert found.select("line").exceptAll(wanted.select("line")).count() == 0
    assert found.count() == wanted.count()
    joins = found._jdf.queryExecution().executedPlan().toString()
    shuffled = "SortMergeJoin" in joins or "ShuffledHashJoin" in joins
    if lines == 0:
        assert shuffled == (span == 0)


def test_nothing_dropped_needs_no_join(spark):
    rows = spark.range(5).select(F.col("id").alias("line"))
    assert new_keys.keep_lines(rows, rows, 5, 5, 5) is rows


def test_a_load_without_markers_by_default_is_kept(spark, tmp_path, store):
    path = write_file(tmp_path / "f.jsonl", [record("a"), "{"])
    conf = spark._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(key, "false")
    try:
        result = load_files(spark, [path], store)
    finally:
        conf.unset(key)
    assert store.read().count() == result.inserted == 1
    assert rejected_records(spark, store, result.load_id).count() == 1


def test_a_stream_takes_only_its_own_old_marker(spark, tmp_path, monkeypatch):
    from pairloom.sources import folders

    folder = tmp_path / "store"
    folder.mkdir()
    with folders.single_writer(spark, str(folder), "stream s"):
        with pytest.raises(WriterBusy):
            with folders.single_writer(spark, str(folder), "stream s"):
                pass
        assert (folder / "_writer").exists()
    (folder / "_writer").write_text("stream s [app-1 x]")
    monkeypatch.setattr(folders, "WRITER_GONE_AFTER", -1)
    with pytest.raises(WriterBusy):
        with folders.single_writer(spark, str(folder), "stream t"):
            pass
    with folders.single_writer(spark, str(folder), "stream s"):
        assert "app-1" not in (folder / "_writer").read_text()
    assert not (folder / "_writer").exists()


def test_a_writer_that_lives_is_not_overtaken(spark, tmp_path, monkeypatch):
    import time

    from pairloom.sources import folders

    monkeypatch.setattr(folders, "WRITER_GONE_AFTER", 3)
    folder = tmp_path / "store"
    folder.mkdir()
    with folders.single_writer(spark, str(folder), "stream s") as long:
        time.sleep(5)
        with pytest.raises(WriterBusy), folders.single_writer(spark, str(folder), "stream s"):
            pass
        long.check()
    assert not (folder / "_writer").exists()


def test_a_writer_taken_for_dead_does_not_commit(spark, tmp_path, store, monkeypatch):
    import time

    from pairloom.sources import folders

    monkeypatch.setattr(folders, "WRITER_GONE_AFTER", 2)
    store.create()
    rows = spark.createDataFrame([(1, "t")], "id long, task_id string")
    for column in STORE_SCHEMA:
        if column.name not in rows.columns:
            rows = rows.withColumn(column.name, F.lit(None).cast(column.dataType))
    with folders.single_writer(spark, store.path, "stream s") as cut_off:
        cut_off._over.set()
        time.sleep(3)
        with folders.single_writer(spark, store.path, "stream s") as newer:
            with pytest.raises(WriterBusy, match="taken over"):
                store.append(rows, 1, "old", 1, cut_off)
            assert store.batches() == [] and not store.has_load("old")
            store.append(rows, 1, "new", 1, newer)
            assert store.read().count() == 1
    assert not Path(store.path, "_writer").exists()


def test_files_passed_over_in_a_folder_are_named(spark, tmp_path, store):
    folder = tmp_path / "in"
    folder.mkdir()
    write_file(folder / "a.jsonl", [record("a")])
    write_file(folder / "b.crc", [record("b")])
    write_file(folder / "_c", [record("c")])
    (folder / "_SUCCESS").write_text("")
    result = load_files(spark, [str(folder)], store)
    assert counts(result) == (3, 0, 0) and [f.status for f in result.files] == ["loaded"] * 3
    assert [Path(p).name for p in result.ignored] == ["_SUCCESS"]


def test_a_new_key_reads_its_bucket_only(spark, tmp_path, store, monkeypatch):
    from pairloom.sources import pair_store

    monkeypatch.setattr(pair_store, "KEYS_PER_BUCKET", 5)
    for n in (100, 40, 3):
        path = write_file(tmp_path / f"{n}.jsonl", [record(f"{n}-{k}") for k in range(n)])
        assert load_files(spark, [path], store).inserted == n
    key = spark.createDataFrame([("100-7",)], "task_id string")
    bucket = key.select(pair_store.key_bucket("task_id")).first()[0]
    found = store.keys([bucket])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(bucket") == 2
    read = [r[0] for r in found.select(F.input_file_name()).distinct().collect()]
    files = [f for f in read if "/_keys/" in f]
    assert {f.split("buckets=")[1].split("/part")[0] for f in files} <= {
        f"{n}/bucket={bucket % n}" for n in (8, 16)
    }
    assert "100-7" in {r.task_id for r in found.collect()}
    assert {f"3-{k}" for k in range(3)} <= {r.task_id for r in found.collect()}
    again = write_file(tmp_path / "again.jsonl", [record("100-7"), record("40-1"), record("x")])
    assert counts(load_files(spark, [again], store)) == (1, 2, 0)
    assert counts(load_files(spark, [path], store)) == (0, 3, 0)


def test_a_batch_without_key_segment_is_looked_up_itself(spark, tmp_path, store, monkeypatch):
    from pairloom.sources import pair_store

    def crash(*_):
        raise OSError("lost")

    path = write_file(tmp_path / "1.jsonl", [record(f"k{k}") for k in range(20)])
    with monkeypatch.context() as broken:
        broken.setattr(PairStore, "merge_keys", crash)
        with pytest.raises(OSError):
            load_files(spark, [path], store)
    assert counts(load_files(spark, [path], store)) == (0, 20, 0)
    # A segment of a batch that is not committed counts for nothing.
    monkeypatch.setattr(pair_store, "KEYS_PER_BUCKET", 2)
    more = write_file(tmp_path / "2.jsonl", [record(f"m{k}") for k in range(20)])
    load_files(spark, [more], store)
    assert store.key_segments()[-1].buckets == 8
    Path(store.batches()[-1].path.removeprefix("file:"), "_SUCCESS").unlink()
    assert [s.buckets for s in store.key_segments()] == [0]
    assert counts(load_files(spark, [more], store)) == (20, 0, 0)


def small_loads(spark, store, n, size=3):
    """`n` batches of `size` rows each, appended without scanning files."""
    for k in range(n):
        first_id = k * (size + 2) + 1
        rows = [(first_id + j, f"{k}-{j}") for j in range(size)]
        rows = spark.createDataFrame(rows, "id long, task_id string").coalesce(1)
        for column in STORE_SCHEMA:
            if column.name not in rows.columns:
                rows = rows.withColumn(column.name, F.lit(None).cast(column.dataType))
        store.append(rows, first_id, f"load-{k}", size)


def test_segments_stay_few_and_a_key_reads_one_bucket(spark, store, monkeypatch):
    from pairloom.sources import pair_store

    monkeypatch.setattr(pair_store, "KEYS_PER_BUCKET", 10)
    monkeypatch.setattr(pair_store, "SMALLEST_SIZE", 20)
    monkeypatch.setattr(pair_store, "MERGE_AT", 4)
    store.create()
    small_loads(spark, store, 26)
    segments = store.key_segments()
    assert len(segments) <= 3 * 4 and sum(s.keys for s in segments) + 3 * sum(not s.buckets for s in segments) == 78
    assert len(store.batches()) == 26
    runs = [(s.first, s.last) for s in segments]
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))
    key = spark.createDataFrame([("3-1",)], "task_id string")
    bucket, hash_ = key.select(pair_store.key_bucket("task_id"), F.xxhash64("task_id")).first()
    found = store.keys([bucket], (hash_, hash_))
    assert "3-1" in {r.task_id for r in found.collect()} and found.count() < 12
    files = {r[0] for r in found.select(F.input_file_name()).collect() if "/_keys/" in r[0]}
    assert len(files) == 1 and "PushedFilters: [IsNotNull(hash)" in str(found._jdf.queryExecution().executedPlan())
    every = store.keys(list(range(pair_store.MOST_BUCKETS)))
    assert every.count() == every.distinct().count() == 78


def test_compaction_keeps_rows_ids_loads_and_exports(spark, tmp_path, store, monkeypatch):
    from pairloom.plans.export import export_shards
    from pairloom.sources import pair_store

    monkeypatch.setattr(pair_store, "MERGE_AT", 3)
    store.create()
    small_loads(spark, store, 11)

    def exported(name):
        rows = store.read().select("*").na.fill("", [f.name for f in STORE_SCHEMA if f.name != "id"])
        for f in STORE_SCHEMA:
            if f.dataType.typeName() == "array":
                rows = rows.withColumn(f.name, F.coalesce(f.name, F.array().cast(f.dataType)))
        export_shards(rows, str(tmp_path / name), 4)
        shards = spark.read.parquet(str(tmp_path / name / "train-*"))
        return sorted(tuple(r) for r in shards.select("_metadata.file_name", "task_id").collect())

    before, rows, last = exported("before"), sorted(map(repr, store.read().collect())), store.last_id()
    assert store.compact(most_rows=13) == 11
    assert [b.merged for b in store.batches()] == [True, True, True]
    assert exported("after") == before and sorted(map(repr, store.read().collect())) == rows
    assert store.last_id() == last and all(store.has_load(f"load-{k}") for k in range(11))
    assert store.drop_compacted() == 11
    assert store.compact(most_rows=30) == 2 and len(store.batches()) == 2
    assert store.drop_compacted() == 2 and store.compact(most_rows=5) == 0
    assert sorted(map(repr, store.read().collect())) == rows
    assert all(store.has_load(f"load-{k}") for k in range(11)) and not store.has_load("load-11")
    assert not any(store.path in s.path and not s.buckets for s in store.key_segments())
    path = write_file(tmp_path / "again.jsonl", [record("3-1"), record("10-2"), record("new")])
    assert counts(load_files(spark, [path], store)) == (1, 2, 0)


def test_a_compaction_that_crashes_changes_nothing(spark, store, monkeypatch):
    from pairloom.sources import pair_store

    store.create()
    small_loads(spark, store, 3)
    with monkeypatch.context() as broken:
        broken.setattr(pair_store, "WITH_MARKER", {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"})
        with pytest.raises(OSError):
            store.compact()
    assert len(store.batches()) == 3 and store.read().count() == 9
    assert store.compact() == 3 and len(store.batches()) == 1 and store.read().count() == 9
