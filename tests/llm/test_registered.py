"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from pairloom.llm import (
    cuckoo_dedup,
    mixing,
    near_jaccard,
    quality_pu,
    queries,
    repeated_units,
    simhash_anchors,
)
from tests.llm.helpers import awkward, rows_of
from tests.oracle import connect, duck_rows, duck_types, spark_rows, spark_types


def test_each_operator_has_a_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_matches_oracle(spark, sf_dir, name):
    con, df = connect(sf_dir), queries.QUERIES[name](spark, sf_dir)
    assert spark_types(df) == duck_types(con, queries.ORACLES[name])
    assert spark_rows(df) == duck_rows(con, queries.ORACLES[name])


def test_every_stage_takes_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = queries.trained_quality(spark, docs, sf_dir)
    stages = dict(corpus_pipeline.STAGES)

    after = stages["quality classifier"](spark, docs, sf_dir)
    scores = quality_pu.score(docs, model)
    wanted = rows_of(scores.filter(scores.score >= queries.QUALITY_THRESHOLD), "doc_id")
    assert rows_of(after, "doc_id") == wanted and len(wanted) < docs.count()

    docs, after = after, stages["exact dedup"](spark, after, sf_dir)
    classes = cuckoo_dedup.exact_dedup(docs)
    assert rows_of(after, "doc_id") == rows_of(classes.filter("kept"), "doc_id")
    assert after.select("text").distinct().count() == after.count()

    docs, after = after, stages["SimHash near-dedup"](spark, after, sf_dir)
    classes = simhash_anchors.simhash_classes(docs).filter("doc_id = component_id")
    one_each = docs.join(classes.select("doc_id"), "doc_id", "left_semi")
    assert rows_of(after, "doc_id") == rows_of(near_jaccard.without_similar(one_each), "doc_id")

    docs, after = after, stages["mixing"](spark, after, sf_dir)
    assert rows_of(after, "doc_id") == rows_of(mixing.draws(docs, queries.MIX), "doc_id")
    assert after.columns == columns

    packed = stages["best-fit packing"](spark, after, sf_dir).toPandas()
    assert len(packed[packed.piece == 0]) == after.count()
    least = -(-packed.length.sum() // 2048)
    assert least <= packed.sequence_id.nunique() <= 1.01 * least + 1


@pytest.mark.parametrize("empty", [False, True])
def test_stages_bear_awkward_documents(spark, sf_dir, empty):
    docs = awkward(spark)
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == awkward(spark).columns, name
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()
    assert (rows == 0) == empty


def test_columns_of_the_caller_stay(spark):
    """Columns with the operators' own names come back with the caller's values."""
    names = (
        "__key __turn __times __plan __docs __digest __id __row_hash __hash __cuts kept_spans row "
        "id source_key plan n times turn digest kept_id hash cuts stays left u v node component"
    ).split()
    docs = awkward(spark).drop("__key", "id")
    clash = [F.concat(F.lit(f"{n}:"), F.coalesce("text", F.lit("-"))).alias(n) for n in names]
    docs = docs.select("*", *clash)
    removed = repeated_units.repeated_units(docs, min_run_words=1)
    results = {
        "mixed": mixing.mixed(docs, queries.MIX),
        "copies": cuckoo_dedup.without_copies(docs),
        "near": simhash_anchors.without_near_copies(docs),
        "similar": near_jaccard.without_similar(docs),
        "quality": quality_pu.without_rejected(docs, None, queries.QUALITY_THRESHOLD),
        "units": repeated_units.without_units(docs.drop("kept_spans"), removed).drop("text"),
    }
    for name, found in results.items():
        kept = [c for c in found.columns if c in names and c != "kept_spans"]
        assert len(kept) >= len(names) - 1, name
        rows = found.select(F.array(*[F.expr(f"substring(`{c}`, {len(c) + 2})") for c in kept]).alias("x"),
                            F.array(*[F.expr(f"startswith(`{c}`, '{c}:')") for c in kept]).alias("own")).collect()
        assert rows and all(all(r.own) and len(set(r.x)) == 1 for r in rows), name


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 100
