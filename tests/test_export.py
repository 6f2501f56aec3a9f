"""Export: exact shards, order, schema, codecs, replacement, guards."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import workload
from pairloom.operators import shards as shards_module
from pairloom.operators.shards import shard_map
from pairloom.plans import export as export_module
from pairloom.plans.export import export_shards, export_store, shard_rows
from pairloom.plans.load import load_files
from pairloom.schema import EXPORT_FIELDS, STORE_SCHEMA
from pairloom.sources.folders import WriterBusy
from pairloom.sources.pair_store import PairStore
from tests.records import record, write_file


def pairs(spark, count, step="id"):
    """`count` rows; `step` turns 0, 1, 2 … into the ids."""
    base = spark.range(count).select(F.expr(f"cast({step} as bigint)").alias("id"))
    columns = [F.lit("v").alias(f) for f in EXPORT_FIELDS]
    rows = base.select("id", *columns)
    for f in STORE_SCHEMA:
        if f.dataType.typeName() == "array":
            value = F.array(F.lit("x")) if not f.nullable else F.lit(None)
            rows = rows.withColumn(f.name, value.cast("array<string>"))
    return rows.withColumn("task_id", F.concat(F.lit("t"), F.col("id"))).withColumn(
        "created_at", F.timestamp_micros(F.col("id") * 1001)
    )


def names(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


def shard_names(count):
    return [f"train-{k:05d}-of-{count:05d}.parquet" for k in range(count)]


def read(folder):
    return [pq.read_table(p).column("task_id").to_pylist() for p in sorted(folder.glob("train-*"))]


@pytest.mark.parametrize("rows, size, count", [(0, 5, 0), (5, 100, 1), (7, 3, 3), (10, 3, 4), (6, 3, 2), (3, 1, 3)])
@pytest.mark.parametrize("step", ["id + 1", "id * 7 + id % 5 - 40"])
def test_exact_contiguous_shards(spark, tmp_path, rows, size, count, step):
    df = pairs(spark, rows, step).orderBy(F.rand(3))
    result = export_shards(df, str(tmp_path / "o"), size)
    assert (result.rows, result.shards) == (rows, count)
    assert names(tmp_path / "o") == shard_names(count)
    ids = [r.id for r in pairs(spark, rows, step).orderBy("id").collect()]
    expected = [[f"t{i}" for i in ids[k : k + size]] for k in range(0, rows, size)]
    assert read(tmp_path / "o") == expected
    assert result.summary() == f"exported {rows} rows to {count} shard(s) in {tmp_path / 'o'}"


STEPS = ["id", "id * 3", "id * id * id", "if(id < 500, id, id + 9000000000)", "id - 700", "if(id = 7, 1125899906842624, id)"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("limits", [(1_000_000, 1_000, 10_000), (40, 4, 3)])
def test_shards_of_any_ids(spark, tmp_path, monkeypatch, step, limits):
    """Wide and uneven gaps, few and wide histogram ranges, several jobs."""
    ranges, group, per_job = limits
    monkeypatch.setattr(shards_module, "MAX_RANGES", ranges)
    monkeypatch.setattr(shards_module, "RANGES_PER_GROUP", group)
    monkeypatch.setattr(export_module, "SHARDS_PER_JOB", per_job)
    df = pairs(spark, 1003, step)
    assert export_shards(df, str(tmp_path / "o"), 100).shards == 11
    ids = sorted(r.id for r in df.select("id").collect())
    assert read(tmp_path / "o") == [[f"t{i}" for i in ids[k : k + 100]] for k in range(0, 1003, 100)]


def test_schema_and_values_of_a_shard(spark, tmp_path, sf_dir):
    workload.pairs(spark, sf_dir).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    export_shards(df, str(tmp_path / "o"), 1000)
    table = pq.read_table(tmp_path / "o" / "train-00000-of-00001.parquet")
    assert table.schema.names == list(EXPORT_FIELDS)
    for field in table.schema:
        assert field.nullable == (field.name in ("references", "artifacts", "created_at"))
        if field.name == "created_at":
            assert field.type == pa.timestamp("us", tz="UTC")
        else:
            assert field.type in (pa.string(), pa.list_(pa.field("element", pa.string())))
    expected = df.orderBy("id").select(*EXPORT_FIELDS).collect()
    got = spark.read.parquet(str(tmp_path / "o")).orderBy("task_id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in expected]
    assert {r.references is None for r in got} == {True, False}


@pytest.mark.parametrize("codec, stored", [("zstd", "ZSTD"), ("snappy", "SNAPPY"), ("gzip", "GZIP"), ("none", "UNCOMPRESSED")])
def test_codecs(spark, tmp_path, codec, stored):
    export_shards(pairs(spark, 3), str(tmp_path / "o"), 10, codec)
    meta = pq.ParquetFile(tmp_path / "o" / "train-00000-of-00001.parquet").metadata
    assert meta.row_group(0).column(0).compression == stored


@pytest.mark.parametrize("size, codec, text", [(0, "zstd", "shard size"), (-5, "zstd", "shard size"), (5, "invalid-codec", "unsupported compression"), (5, "lz4", "unsupported compression")])
def test_bad_options_touch_nothing(spark, tmp_path, size, codec, text):
    with pytest.raises(ValueError, match=text):
        export_shards(pairs(spark, 3), str(tmp_path / "o"), size, codec)
    assert not (tmp_path / "o").exists()


def test_old_shards_are_replaced_and_other_files_stay(spark, tmp_path):
    out = tmp_path / "o"
    export_shards(pairs(spark, 3), str(out), 1)
    (out / "README.md").write_text("keep")
    (out / "train-notes.txt").write_text("keep")
    (out / "train-dir.parquet").mkdir()
    kept = ["README.md", "train-dir.parquet", "train-notes.txt"]
    assert names(out) == sorted(shard_names(3) + kept)
    export_shards(pairs(spark, 1), str(out), 10)
    assert names(out) == sorted(shard_names(1) + kept)
    assert export_shards(pairs(spark, 0), str(out), 10).shards == 0
    assert names(out) == kept


def test_null_in_a_required_column_fails_and_keeps_the_old_shards(spark, tmp_path):
    out = tmp_path / "o"
    export_shards(pairs(spark, 3), str(out), 1)
    for column in ("context", "plan"):
        kind = STORE_SCHEMA[column].dataType
        bad = pairs(spark, 9).withColumn(
            column, F.when(F.col("id") != 4, F.col(column)).cast(kind)
        )
        with pytest.raises(Exception, match=f"NULL in required column {column}"):
            export_shards(bad, str(out), 2)
        assert names(out) == shard_names(3)


def test_ids_have_to_be_there_and_unique(spark, tmp_path):
    with pytest.raises(ValueError, match="1 row\\(s\\) without id"):
        export_shards(pairs(spark, 3, "if(id = 1, null, id)"), str(tmp_path / "o"), 1)
    for step in ("if(id = 1, 0, id)", "if(id = 2, 5, id * 5)"):
        with pytest.raises(RuntimeError, match="unique"):
            export_shards(pairs(spark, 4, step), str(tmp_path / "o"), 1)
    assert names(tmp_path / "o") == []


def test_one_export_at_a_time(spark, tmp_path):
    out = tmp_path / "o"
    out.mkdir()
    (out / "_writer").write_text("another export")
    with pytest.raises(WriterBusy, match="another export"):
        export_shards(pairs(spark, 3), str(out), 1)
    assert names(out) == ["_writer"]


def test_store_export(spark, tmp_path):
    store = PairStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        export_store(store, str(tmp_path / "o"))
    values = [record("c"), record("a"), "bad", record("c"), record("b", references=["r"])]
    load_files(spark, [write_file(tmp_path / "f.jsonl", values)], store)
    load_files(spark, [write_file(tmp_path / "g.jsonl", [record("0")])], store)
    assert export_store(store, str(tmp_path / "o"), 3).shards == 2
    assert read(tmp_path / "o") == [["c", "a", "b"], ["0"]]


def test_missing_columns_are_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        export_shards(pairs(spark, 3).drop("plan"), str(tmp_path / "o"), 1)


def test_rows_are_shuffled_once_and_pruned_by_id(spark, tmp_path):
    pairs(spark, 1003, "id * 3").write.parquet(str(tmp_path / "p"))
    pairs(spark, 1003).write.parquet(str(tmp_path / "d"))
    for name in ("p", "d"):
        df = spark.read.parquet(str(tmp_path / name))
        plan = shard_rows(df, shard_map(df, 100, str(tmp_path / f"w{name}")), 2, 5)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") - text.count("BroadcastExchange") == 1
        assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id" in text
        assert plan.rdd.getNumPartitions() == 4


def test_one_far_id_leaves_even_ranges(spark, tmp_path, monkeypatch):
    """From counts alone, no range keeps more than a few shards' rows."""
    monkeypatch.setattr(shards_module, "MAX_RANGES", 50)
    far = "if(id = 9, 1125899906842624, if(id % 2 = 0, id, id + 5000000000000))"
    df = pairs(spark, 3000, far)
    found = shard_map(df, 20, str(tmp_path / "w"))
    assert found.shards == 150 and len(found.cuts) > 2
    ranged = shards_module.with_range(df, found, "id", "start")
    rows = ranged.groupBy("start").count().collect()
    assert max(r["count"] for r in rows) <= 4 * 20 and len(rows) <= 3000
    assigned = found.assign(df, 0, found.shards - 1).select("id", "shard").collect()
    order = {i: k // 20 for k, i in enumerate(sorted(r.id for r in assigned))}
    assert len(order) == 3000 and all(order[r.id] == r.shard for r in assigned)
    assert all(cut.count() <= 3000 // (4 * 20) for _, cut in found.cuts)


@pytest.mark.parametrize("broken", ["delete_file", "rename_file"])
def test_a_swap_cut_short_is_finished(spark, tmp_path, monkeypatch, broken):
    out = tmp_path / "o"
    export_shards(pairs(spark, 12), str(out), 3)
    (out / "notes.txt").write_text("mine")
    real, calls = getattr(export_module, broken), []

    def fails_the_third_time(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(export_module, broken, fails_the_third_time)
    with pytest.raises(OSError, match="lost"):
        export_shards(pairs(spark, 20, "id + 100"), str(out), 5)
    monkeypatch.setattr(export_module, broken, real)
    assert export_module.finish_export(spark, str(out))
    assert names(out) == ["notes.txt", *shard_names(4)]
    assert read(out) == [[f"t{i + 100}" for i in range(k, k + 5)] for k in range(0, 20, 5)]
    assert not export_module.finish_export(spark, str(out))


def test_the_next_export_finishes_a_swap_first(spark, tmp_path, monkeypatch):
    out = tmp_path / "o"
    real = export_module.rename_file
    monkeypatch.setattr(export_module, "rename_file", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        export_shards(pairs(spark, 6), str(out), 3)
    monkeypatch.setattr(export_module, "rename_file", real)
    doubled = pairs(spark, 4).union(pairs(spark, 4))
    with pytest.raises(RuntimeError, match="add up"):
        export_shards(doubled, str(out), 3)
    assert read(out) == [["t0", "t1", "t2"], ["t3", "t4", "t5"]]


def test_a_plan_cut_short_and_left_shards(spark, tmp_path):
    out = tmp_path / "o"
    export_shards(pairs(spark, 6), str(out), 3)
    (out / "_publish.json").write_text('{"staging": "x')
    (out / "_staging-old").mkdir()
    assert not export_module.finish_export(spark, str(out))
    assert names(out) == shard_names(2)
    (out / "_publish.json").write_text('{"staging": "/gone/_staging-1", "shards": 9}')
    with pytest.raises(RuntimeError, match="nowhere"):
        export_module.finish_export(spark, str(out))
    assert names(out) == ["_publish.json", *shard_names(2)]
