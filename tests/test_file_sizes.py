"""Inputs and batches are written in files of bounded size, which change no result."""

import os
from pathlib import Path

import pytest

import registered
import workload
from pairloom.plans.load import load_files
from pairloom.sources import pair_store
from pairloom.sources.pair_store import PairStore
from tests.conftest import SF_DIR
from tests.oracle import connect, duck_rows, spark_rows
from tests.records import record, write_file

BYTES = 30_000


@pytest.mark.parametrize(
    "name", ["coverage_file", "load_reject_lines", "coverage_incremental"]
)
def test_large_inputs_are_cut_into_files(spark, sf_dir, monkeypatch, name):
    given = []

    def load(spark, paths, *args):
        for path in (Path(p.removeprefix("file:")) for p in paths):
            files = path.glob("part-*") if path.is_dir() else [path]
            given.extend(os.path.getsize(file) for file in files)
        return load_files(spark, paths, *args)

    monkeypatch.setattr(workload, "FILE_BYTES", BYTES)
    monkeypatch.setattr(registered, "load_files", load)
    rows = spark_rows(registered.QUERIES[name](spark, sf_dir))
    assert rows == duck_rows(connect(SF_DIR), registered.ORACLES[name])
    assert len(given) > 12 and max(given) < 2 * BYTES


def test_a_compacted_batch_has_files_of_bounded_bytes(spark, tmp_path, monkeypatch):
    store = PairStore(spark, str(tmp_path / "store"))
    for k in range(2):
        texts = [record(f"{k}-{i}", final_answer="x" * 1000) for i in range(20)]
        load_files(spark, [write_file(tmp_path / f"{k}.jsonl", texts)], store)
    rows = sorted(map(repr, store.read().collect()))
    monkeypatch.setattr(pair_store, "BYTES_PER_FILE", 8000)
    assert store.compact() == 2
    (batch,) = store.batches()
    assert len(list(Path(batch.path.removeprefix("file:")).glob("part-*"))) > 4
    assert sorted(map(repr, store.read().collect())) == rows
