import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pairloom.llm import simhash_anchors as simhash
from pairloom.llm.common import Scratch
from pairloom.llm.components import connected_components
from tests.llm.helpers import awkward, components, documents, rows_of


def print_of(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles or [b" ".join(words)]]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def test_fingerprints_of_awkward_texts(spark):
    docs = awkward(spark)
    found = rows_of(simhash.fingerprints(docs), "id", "print")
    wanted = [(r.doc_id, print_of(r.text)) for r in docs.collect()]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in wanted]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(found, key=key) == sorted(signed, key=key)


def test_words_are_read_in_parts_without_a_seam(monkeypatch):
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 4)
    import pyarrow as pa

    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(14)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(14)), "text": texts})
    (out,) = simhash._fingerprints(3)(iter([batch]))
    assert [int(p) % (1 << 64) for p in out.column("print").to_pylist()] == [
        print_of(t) for t in texts
    ]


def test_anchors_bring_every_close_pair_together(spark):
    pick = random.Random(2)
    base = [pick.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << i for i in pick.sample(range(64), pick.randint(1, 2))) for b in base]
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in base + near]
    found = spark.createDataFrame(rows, "p long").select("p", simhash.anchors(F.col("p")).alias("a"))
    keys = {r.p % (1 << 64): set(r.a) for r in found.collect()}
    assert all(keys[a] & keys[b] for a, b in zip(base, near))
    assert max(len(k) for k in keys.values()) == 17


@pytest.mark.parametrize("most_per_anchor", [4096, 1])
def test_classes_equal_brute_force(spark, most_per_anchor):
    pick = random.Random(3)
    vocabulary = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = [pick.choice(vocabulary) for _ in range(400)]
        rows.append((10 * i, " ".join(words), "s"))
        for k in range(pick.randint(0, 4)):
            words[pick.randrange(400)] = "edited"
            rows.append((10 * i + k + 1, " ".join(words), "s"))
    prints = [print_of(t) for _, t, _ in rows]
    roots = components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    found = simhash.simhash_classes(documents(spark, rows), most_per_anchor=most_per_anchor)
    wanted = sorted((i, f"{p:016x}", rows[r][0]) for (i, _, _), p, r in zip(rows, prints, roots))
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == wanted
    assert len(set(roots)) < len(rows)


def test_one_crowded_ball_needs_no_pairs(spark):
    rows = [(0,), *[(1 << i,) for i in range(63)], *[(3 << i,) for i in range(60)]]
    scratch = Scratch(spark, "test")
    links = simhash.near_links(spark.createDataFrame(rows, "print long").distinct(), scratch)
    assert links.count() < 17 * len(rows)
    joined = connected_components(links, scratch)
    assert joined.select("component").distinct().count() == 1
    assert joined.count() == len(rows)


def test_awkward_classes(spark):
    found = rows_of(simhash.simhash_classes(awkward(spark)), "doc_id", "component_id")
    assert (3, 2) in found and (5, 2) in found and (None, 2) in found  # no words: all linked
    assert found.count((4, 1)) == 2
    assert (2**60 + 1, 2**60) in found
    assert (None, None) in found


def test_one_document_of_each_class_stays(spark):
    docs = awkward(spark)
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == [(1,), (2,), (6,), (2**60,), (None,), (None,)]
    assert simhash.without_near_copies(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    links = spark.createDataFrame(chain + hub + [(5, 5), (3, 2)], "u long, v long")
    found = dict(connected_components(links, Scratch(spark, "test")).collect())
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(400)}}
    none = spark.createDataFrame([], "u long, v long")
    assert connected_components(none, Scratch(spark, "test")).count() == 0


def test_hamming_code_is_perfect():
    words = np.random.default_rng(0).integers(0, 1 << 31, 200)
    for w in words.tolist():
        syndrome = 0
        for place in range(1, 32):
            if w >> (place - 1) & 1:
                syndrome ^= place
        fixed = w ^ (1 << (syndrome - 1) if syndrome else 0)
        again = 0
        for place in range(1, 32):
            if fixed >> (place - 1) & 1:
                again ^= place
        assert again == 0
