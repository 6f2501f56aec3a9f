"""Coverage from kept counts against coverage from the rows."""

import pytest

from pairloom.operators.coverage import coverage_long
from pairloom.plans import running_coverage as running
from pairloom.plans.coverage_report import write_coverage
from pairloom.plans.load import load_files
from pairloom.sources.folders import glob
from pairloom.sources.pair_store import Batch, PairStore
from tests.records import record, write_file


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return PairStore(spark, str(tmp_path / "store"))


def load(spark, tmp_path, store, *names, **fields):
    path = tmp_path / f"{names[0]}.jsonl"
    write_file(path, [record(name, **fields) for name in names])
    load_files(spark, [str(path)], store)


def test_counts_of_new_batches_are_added(spark, tmp_path, store, monkeypatch):
    read = []
    real = PairStore.read_batches
    monkeypatch.setattr(
        PairStore, "read_batches", lambda s, run: read.append(len(run)) or real(s, run)
    )
    load(spark, tmp_path, store, "a", "b")
    load(spark, tmp_path, store, "c", difficulty="hard")
    assert rows(running.running_coverage(store)) == rows(coverage_long(store.read()))
    assert read == [2]
    load(spark, tmp_path, store, "d", capability_tags=["planning", "planning"])
    assert rows(running.running_coverage(store)) == rows(coverage_long(store.read()))
    assert rows(running.running_coverage(store)) == rows(coverage_long(store.read()))
    assert read == [2, 1]


def test_compaction_keeps_counts_that_end_where_batches_do(spark, tmp_path, store):
    load(spark, tmp_path, store, "a")
    load(spark, tmp_path, store, "b")
    running.running_coverage(store)
    store.compact()
    store.drop_compacted()
    assert len(running.kept_counts(store, store.batches())) == 1
    load(spark, tmp_path, store, "c", difficulty="hard")
    store.compact()
    store.drop_compacted()
    # The batch now reaches past the counts, so its rows are counted anew.
    assert running.kept_counts(store, store.batches()) == []
    assert rows(running.running_coverage(store)) == rows(coverage_long(store.read()))


def test_kept_counts_are_merged(spark, tmp_path, store, monkeypatch):
    monkeypatch.setattr(running, "MERGE_AT", 2)
    for name in "abc":
        load(spark, tmp_path, store, name)
        found = running.running_coverage(store)
        assert rows(found) == rows(coverage_long(store.read()))
        assert len(glob(spark, f"{store.path}/_counts/from=*/to=*/_SUCCESS")) == 1


def test_runs_do_not_reach_over_kept_counts():
    batches = [Batch(k, k, str(k)) for k in (1, 5, 9, 12)]
    runs = running.uncounted_runs(batches, [running.Counted(5, 9, "")])
    assert [[b.first_id for b in run] for run in runs] == [[1], [12]]


def test_empty_and_missing_stores(spark, tmp_path, store):
    with pytest.raises(FileNotFoundError):
        running.running_coverage(store)
    empty = write_coverage(spark, store, str(tmp_path / "c.json"), running=True)
    assert '"total_count": 0' in empty
    store.create()
    assert running.running_coverage(store).count() == 0


def test_the_file_is_the_same_either_way(spark, tmp_path, store):
    load(spark, tmp_path, store, "a", "b")
    texts = {
        write_coverage(spark, store, str(tmp_path / "c.json"), running=way).split("generated_at")[0]
        for way in (True, False)
    }
    assert len(texts) == 1
