import random

import pytest

import corpus_pipeline
from pairloom.llm import near_jaccard
from tests.llm.helpers import awkward, components, documents, rows_of


def edited(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return words


def corpus():
    pick = random.Random(11)
    texts = []
    for size in (20, 60, 100, 300, 900):
        for _ in range(6):
            words = [f"w{pick.randrange(500)}" for _ in range(size)]
            texts.append(words)
            texts += [edited(pick, words, pick.randint(0, max(1, size // 30))) for _ in range(4)]
    pick.shuffle(texts)
    return [(i, " ".join(words), "s") for i, words in enumerate(texts)]


def linked(one, other):
    a, b = (
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (one.split(), other.split())
    )
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_force(rows):
    return components(len(rows), lambda i, j: linked(rows[i][1], rows[j][1]))


def similar_pairs(docs):
    texts = [t for (t,) in rows_of(docs, "text")]
    return sum(linked(a, b) for i, a in enumerate(texts) for b in texts[:i])


@pytest.mark.parametrize("tile", [256, 3])
def test_classes_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(near_jaccard, "TILE", tile)
    rows = corpus()
    wanted = sorted(enumerate(brute_force(rows)))
    found = near_jaccard.jaccard_classes(documents(spark, rows))
    assert rows_of(found, "doc_id", "component_id") == wanted


def test_the_pipeline_leaves_no_near_copies(spark, sf_dir):
    docs = documents(spark, corpus())
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, sf_dir)
    assert similar_pairs(docs) > 0  # more than two bits apart
    for _, stage in corpus_pipeline.STAGES[3:-2]:
        docs = stage(spark, docs, sf_dir)
    assert similar_pairs(docs) == 0 and docs.count() >= 30


@pytest.mark.parametrize("rows", [0, 11])
def test_awkward_documents(spark, rows):
    docs = awkward(spark).limit(rows) if not rows else awkward(spark)
    assert near_jaccard.jaccard_classes(docs).count() == docs.count()
    assert near_jaccard.without_similar(docs).columns == docs.columns
