"""Working folders and settings."""

from types import SimpleNamespace

import pytest

from pairloom.session import SETTINGS, engine_settings, work_folder, written


def without_shared_folder(spark):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    return SimpleNamespace(conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)


def test_work_folder_lies_in_the_shared_folder(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    with work_folder(spark, str(tmp_path)) as folder:
        assert folder.startswith(f"{shared}/pairloom-")
        table = written(spark.range(10).toDF("n"), f"{folder}/t")
        assert table.count() == 10
    assert not list(tmp_path.iterdir())
    with pytest.raises(Exception, match="(?i)does not exist|not found|path"):
        spark.read.parquet(f"{folder}/t").count()


def test_work_folder_beside_the_data_where_there_is_no_shared_one(spark, tmp_path):
    with work_folder(without_shared_folder(spark), str(tmp_path)) as folder:
        spark.range(3).write.parquet(f"{folder}/t")
        assert [p.name.startswith("_work-") for p in tmp_path.iterdir()] == [True]
    assert not list(tmp_path.iterdir())


def test_settings_are_put_back_after_an_error(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    with pytest.raises(KeyError):
        with engine_settings(spark):
            assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS
            raise KeyError
    assert {key: spark.conf.get(key, None) for key in SETTINGS} == before
