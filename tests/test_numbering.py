"""Line numbers over groups of splits: the same numbers, and no line is moved for them."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions.record import MAX_LINE_BYTES
from pairloom.operators import numbering
from pairloom.plans.load import checked_lines
from pairloom.session import engine_settings, written
from pairloom.sources.jsonl import find_files, scan_lines
from tests.records import record, write_file


def numbered(spark, tmp_path, paths, name):
    """Lines of the files with their numbers, as a load gives them."""
    with engine_settings(spark):
        files = find_files(spark, paths, str(tmp_path / f"{name}-staged"))
        lines = checked_lines(scan_lines(spark, files))
        checked = written(lines, str(tmp_path / f"{name}-lines"))
        splits = written(numbering.split_table(checked), str(tmp_path / f"{name}-splits"))
    per_file = numbering.lines_per_file(splits)
    order = [f.uri for f in files]
    return numbering.number_lines(spark, checked, splits, order, per_file)


@pytest.fixture
def inputs(spark, tmp_path):
    """Files of several splits each, given in no order of names, one of them twice."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    paths, expected = [], []
    for name, n in (("c", 60), ("a", 1), ("b", 45)):
        values = [record(f"{name}{k}", context="x" * (k % 7)) for k in range(n)]
        paths.append(write_file(tmp_path / f"{name}.jsonl", values))
    paths.append(paths[0])
    for ord_, (name, n) in enumerate((("c", 60), ("a", 1), ("b", 45), ("c", 60))):
        expected += [(len(expected) + k, ord_, k + 1, f"{name}{k}") for k in range(n)]
    yield paths, expected
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("splits, files", [(10**6, 10**5), (0, 0), (3, 0), (7, 10**5)])
def test_groups_of_splits_give_the_same_numbers(
    spark, tmp_path, monkeypatch, inputs, splits, files
):
    paths, expected = inputs
    monkeypatch.setattr(numbering, "SPLITS_TO_BROADCAST", splits)
    monkeypatch.setattr(numbering, "FILES_TO_BROADCAST", files)
    found = numbered(spark, tmp_path, paths, "in")
    rows = found.select("line", "file_ord", "line_no", "rec.task_id").orderBy("line").collect()
    assert [tuple(r) for r in rows] == expected


def test_no_line_is_moved_beyond_the_limits(spark, tmp_path, monkeypatch, inputs):
    paths, _ = inputs
    monkeypatch.setattr(numbering, "SPLITS_TO_BROADCAST", 0)
    monkeypatch.setattr(numbering, "FILES_TO_BROADCAST", 0)
    found = numbered(spark, tmp_path, paths, "in")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1 and plan.count("BroadcastHashJoin") > 1
    # Where rows are shuffled, by a join or otherwise, these are never the lines.
    for node in plan.split("\n"):
        if "Exchange hashpartitioning" in node or "Exchange rangepartitioning" in node:
            assert "rec" not in node and "mid" not in node.replace("first_mid", "")
    shuffled = [p for p in plan.split("Exchange hashpartitioning")[1:]]
    assert all("rec#" not in part.split("FileScan")[1] for part in shuffled if "FileScan" in part)
    # Each group reads its own range of lines only.
    assert plan.count("GreaterThanOrEqual(mid,") == plan.count("LessThanOrEqual(mid,") > 1


def test_an_over_long_line_ends_its_file_in_any_group(spark, tmp_path, monkeypatch):
    cut = write_file(
        tmp_path / "cut.jsonl", [record("a"), "z" * MAX_LINE_BYTES, record("b"), record("c")]
    )
    fine = write_file(tmp_path / "fine.jsonl", [record("d")])
    found = []
    for name, limit in (("one", 10**6), ("many", 0)):
        monkeypatch.setattr(numbering, "SPLITS_TO_BROADCAST", limit)
        rows = numbered(spark, tmp_path, [cut, fine], name).where(F.col("rec").isNotNull())
        found.append([tuple(r) for r in rows.select("line", "line_no", "rec.task_id").collect()])
    assert sorted(found[0]) == sorted(found[1]) == [(0, 1, "a"), (4, 1, "d")]
