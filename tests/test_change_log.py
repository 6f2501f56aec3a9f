"""The log of a scheduled load: bounded in the driver, kept short, complete."""

import os
import time

import pytest

from pairloom.sources import change_log
from pairloom.sources.change_log import FILE_SCHEMA, ChangeLog, files_in
from pairloom.sources.folders import WriterBusy, single_writer
from pairloom.sources.pair_store import PairStore
from pairloom.streaming import ingest
from tests.records import record, write_file
from tests.test_streaming import arrive, rows, totals


@pytest.fixture
def source(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def listed(spark, folder, ignored=None):
    return sorted(map(tuple, files_in(spark, str(folder), ignored).collect()))


def test_files_are_listed_as_the_file_system_shows_them(spark, source):
    assert listed(spark, source) == []
    names = ["a b.jsonl", "ünï%20[x]{y}*.jsonl", "_odd.jsonl", ".dot.jsonl"]
    for at, name in enumerate(names):
        (source / name).write_text("x" * (at + 1))
        os.utime(source / name, (1_700_000_000 + at, 1_700_000_000.25 + at))
    # Empty files hold no record and are not listed.
    for name in ("empty.jsonl", "_empty.jsonl"):
        (source / name).write_text("")
    (source / "_SUCCESS").write_text("")
    (source / "deeper").mkdir()
    (source / "deeper" / "in.jsonl").write_text("x")
    (source / "day=1").mkdir()
    (source / "day=1" / "in.jsonl").write_text("x")
    ignored = []
    found = listed(spark, source, ignored)
    assert [(os.path.basename(p), m, s) for p, m, s in found] == sorted(
        (name, 1_700_000_000_250 + 1000 * at, at + 1)
        for at, name in enumerate(names)
    )
    assert [os.path.basename(p) for p in ignored] == ["_SUCCESS"]
    schema = files_in(spark, str(source)).schema
    assert [f.name for f in schema] == ["path", "modified", "size"]


def test_a_folder_with_glob_characters(spark, tmp_path):
    folder = tmp_path / "in [1]{a,b}"
    folder.mkdir()
    (folder / "f.jsonl").write_text("x")
    (folder / "_g.jsonl").write_text("xy")
    assert [s for _, _, s in listed(spark, folder)] == [2, 1]


def test_the_last_sight_of_a_file_counts(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"))
    assert log.last() == 0 and log.seen().count() == 0
    log.plan(1, [("a", 1, 1), ("b", 1, 1)])
    log.plan(2, [("a", 2, 1)])
    log.plan(3, [("c", 1, 1)])
    assert log.last() == 3 and not log.is_done(3)
    assert log.files_of(1) == [("a", 1, 1), ("b", 1, 1)]
    # An earlier time or another size is a change as well.
    now = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 1, 1), ("d", 1, 1)], FILE_SCHEMA)
    assert sorted(r.path for r in log.changed(now).collect()) == ["a", "b", "d"]


def test_a_plan_without_its_marker_does_not_count(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"))
    log.plan(1, [("a", 1, 1)])
    log.plan(2, [("b", 1, 1)])
    os.remove(tmp_path / "log" / "plans" / "number=2" / "_SUCCESS")
    assert log.last() == 1
    log.plan(2, [("c", 1, 1)])
    assert sorted(r.path for r in log.seen().collect()) == ["a", "c"]


def test_many_loads_leave_few_folders(spark, tmp_path, source, monkeypatch):
    monkeypatch.setattr(change_log, "LOADS_PER_STATE", 3)
    store, log = PairStore(spark, str(tmp_path / "store")), tmp_path / "log"
    for at in range(7):
        arrive(source / f"{at % 5}.jsonl", [f"t{at}"], 1_700_000_000 + at)
        assert totals(ingest.load_arrivals(spark, str(source), store, str(log))) == [(1, 0, 0)]
    assert ingest.load_arrivals(spark, str(source), store, str(log)) == []
    assert [p.name for p in sorted((log / "states").iterdir())] == ["number=6"]
    assert [p.name for p in sorted((log / "plans").iterdir())] == ["number=7"]
    assert [p.name for p in log.glob("*.done")] == ["7.done"]
    assert sorted(r[0] for r in rows(store)) == [f"t{at}" for at in range(7)]
    assert len(store.batches()) == 7


def test_numbers_of_a_log_of_the_earlier_form_are_not_given_again(spark, tmp_path, source):
    store, log = PairStore(spark, str(tmp_path / "store")), tmp_path / "log"
    arrive(source / "1.jsonl", ["a"], 1_700_000_000)
    ingest.load_arrivals(spark, str(source), store, str(log))
    stream_id = (log / "load_stream_id").read_text()
    old = tmp_path / "old"
    old.mkdir()
    (old / "load_stream_id").write_text(stream_id)
    (old / "1.plan").write_text("{}")
    arrive(source / "2.jsonl", ["b"], 1_700_000_001)
    (result,) = ingest.load_arrivals(spark, str(source), store, str(old))
    assert (result.inserted, result.skipped, result.replayed) == (1, 1, False)
    assert ChangeLog(spark, str(old)).last() == 2


def test_two_runs_do_not_share_a_log(spark, tmp_path, source):
    store, log = PairStore(spark, str(tmp_path / "store")), str(tmp_path / "log")
    write_file(source / "1.jsonl", [record("a")])
    ingest.load_arrivals(spark, str(source), store, log)
    owner = f"arrivals {ingest._stream_id(spark, log)}"
    with single_writer(spark, log, owner), pytest.raises(WriterBusy):
        ingest.load_arrivals(spark, str(source), store, log)


def test_what_is_passed_over_is_named(spark, tmp_path, source):
    store, log = PairStore(spark, str(tmp_path / "store")), str(tmp_path / "log")
    write_file(source / "1.jsonl", [record("a")])
    (source / "_SUCCESS").write_text("")
    (result,) = ingest.load_arrivals(spark, str(source), store, log)
    assert [os.path.basename(p) for p in result.ignored] == ["_SUCCESS"]


def test_twenty_thousand_files_seen_before(spark, tmp_path, source):
    """Five of them changed; a run is the five's load and one look at the folder."""
    store, path = PairStore(spark, str(tmp_path / "store")), str(tmp_path / "log")
    for k in range(20_000):
        (source / f"{k:06d}.jsonl").write_bytes(b"\n")
    log = ChangeLog(spark, path)
    seen = files_in(spark, str(source)).selectExpr("*", "1L AS number")
    log._write(seen.repartition(1), log._folder("states", 1))
    for k in range(5):
        write_file(source / f"{k * 4_000:06d}.jsonl", [record(f"t{k}")])
    start = time.monotonic()
    results = ingest.load_arrivals(spark, str(source), store, path)
    assert time.monotonic() - start < 60
    assert totals(results) == [(5, 0, 0)]
    assert log.seen().count() == 20_000 and log.last() == 2
