import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality_pu as quality
from tests.llm.helpers import awkward, documents, rows_of


def text(pick, good):
    words = ["".join(pick.choice("aeioulnrst") for _ in range(pick.randint(2, 8))) for _ in range(80)]
    if not good:
        words = [w.upper() + "!!" for w in words]
    return " ".join(words)


def test_prior_is_estimated_without_negatives():
    random_ = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        positive = random_.normal(3, 1, 4000)
        good = random_.random(8000) < share
        unlabelled = np.where(good, random_.normal(3, 1, 8000), random_.normal(-3, 1, 8000))
        assert quality.estimated_prior(positive, unlabelled) == pytest.approx(share, abs=0.05)


def test_risk_stays_sound_where_its_second_part_is_negative():
    random_ = np.random.default_rng(1)
    positive = random_.normal(1, 0.1, (500, 3))
    unlabelled = np.vstack([positive, random_.normal(-1, 0.1, (500, 3))])
    model = quality.fit(positive, random_.permutation(unlabelled))
    assert model.prior == pytest.approx(0.5, abs=0.1)
    assert (model.scores(unlabelled[:500]) > 0.5).all()
    assert (model.scores(unlabelled[500:]) < 0.5).all()


def test_junk_is_told_from_prose(spark):
    pick = random.Random(2)
    rows = [(i, text(pick, i % 4 > 0), "s") for i in range(400)]
    docs = documents(spark, rows)
    trusted = docs.filter("doc_id % 4 > 0 and doc_id % 3 = 0").select(F.col("doc_id").alias("id"))
    model = quality.learn(docs, trusted)
    assert 0.6 < model.prior < 0.9
    found = dict(quality.score(docs, model).collect())
    assert all((found[i] >= 0.3) == (i % 4 > 0) for i in range(400))
    left = quality.without_rejected(docs, model, 0.3)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i in range(400) if i % 4 > 0}


def test_awkward_documents(spark):
    docs = awkward(spark)
    trusted = docs.filter("doc_id = 1 or doc_id = 4").select(F.col("doc_id").alias("id"))
    model = quality.learn(docs, trusted)
    found = quality.score(docs, model)
    assert found.count() == docs.count()
    assert found.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality.without_rejected(docs, model, 0.0).count() == docs.count()
    assert quality.without_rejected(docs, model, 1.1).count() == 0


def test_nothing_to_learn_from(spark):
    docs = awkward(spark)
    none = docs.limit(0).select(F.col("doc_id").alias("id"))
    assert quality.learn(docs, none) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.learn(docs.limit(0), docs.select(F.col("doc_id").alias("id"))) is None
    assert quality.score(docs.limit(0), None).count() == 0
    assert quality.without_rejected(docs, None, 0.3).count() == docs.count()


def test_held_out_fold(spark):
    found = spark.range(50).select("id", quality.held_out(F.col("id"))).collect()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in found)


def test_held_out_accuracy_on_the_test_tables(spark):
    from pairloom.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = queries.op6_quality_pu(spark, sf_dir).join(labels, "doc_id").filter("held_out")
    assert found.count() > 50
    assert found.filter("predicted = quality").count() >= 0.95 * found.count()
    assert rows_of(found.filter("predicted is null"), "doc_id") == []
