import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pairloom.llm import cuckoo_dedup as cuckoo
from tests.llm.helpers import awkward, documents, rows_of


def test_filter_keeps_what_it_holds_and_forgets_what_is_removed():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    held = cuckoo.filled(64, keys)
    assert all(k in held for k in keys)
    for k in keys[:1500]:
        held.remove(k)
    assert all(k in held for k in keys[1500:])
    assert sum(k in held for k in keys[:1500]) < 30


def test_filter_overflows_and_grows_from_the_keys():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(500)]
    small = cuckoo.CuckooFilter(8)
    assert not all(small.insert(k) for k in keys)
    assert cuckoo.filled(8, keys).mask + 1 >= 128


def test_equal_fingerprints_do_not_join_different_digests():
    a = bytes(32)
    b = a[:16] + b"\x01" * 16  # same bucket and fingerprint, another digest
    shard = cuckoo.Shard([], 8)
    shard.apply(a, 1, 5)
    shard.apply(b, 1, 6)
    shard.apply(a, 2, 9)
    found = {d: (n, keep) for d, n, keep, _, _ in shard.rows() if d is not None}
    assert found == {a: (3, 9), b: (1, 6)}


def test_awkward_documents(spark):
    found = rows_of(
        cuckoo.exact_dedup(awkward(spark)), "doc_id", "keep_id", "group_size", "kept"
    )
    assert found == [
        (1, 4, 3, False),
        (2, 3, 3, False),
        (3, 3, 3, True),
        (4, 4, 3, True),
        (4, 4, 3, True),
        (5, 5, 1, True),
        (6, 6, 1, True),
        (2**60, 2**60 + 1, 2, False),
        (2**60 + 1, 2**60 + 1, 2, True),
        (None, 3, 3, False),
        (None, None, 1, True),
    ]


def test_without_copies_keeps_one_row_of_each_text(spark):
    docs = awkward(spark)
    left = cuckoo.without_copies(docs)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == [(3,), (4,), (5,), (6,), (2**60 + 1,), (None,)]
    unique = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert cuckoo.without_copies(unique).count() == 5


def test_empty_table(spark):
    docs = awkward(spark).limit(0)
    assert cuckoo.exact_dedup(docs).count() == 0
    assert cuckoo.without_copies(docs).count() == 0


@pytest.mark.parametrize("first_buckets", [1, 64])
def test_index_follows_insertions_and_deletions(spark, tmp_path, first_buckets):
    pick = random.Random(1)
    live: list[tuple[int, str]] = []
    index = cuckoo.CuckooIndex(spark, str(tmp_path / "index"), 3, first_buckets)
    fresh = iter(range(10_000))
    for _ in range(3):
        batch = [(next(fresh), f"text {pick.randrange(40)}") for _ in range(60)]
        index.insert(cuckoo.digests(documents(spark, [(i, t, "s") for i, t in batch])))
        live += batch
        gone = pick.sample(live, 25)
        index.delete(cuckoo.digests(documents(spark, [(i, t, "s") for i, t in gone])))
        live = [x for x in live if x not in gone]
        expected: dict[str, list[int]] = {}
        for i, t in live:
            expected.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(i)
        found = index.classes().select(F.lower(F.hex("digest")), "n", "keep").collect()
        assert {d: (n, keep) for d, n, keep in found} == {
            d: (len(ids), max(ids)) for d, ids in expected.items()
        }


def test_deleting_what_is_not_there_changes_nothing(spark, tmp_path):
    index = cuckoo.CuckooIndex(spark, str(tmp_path / "index"), 2)
    index.insert(cuckoo.digests(documents(spark, [(1, "a", "s"), (2, "a", "s")])))
    index.delete(cuckoo.digests(documents(spark, [(7, "a", "s"), (1, "b", "s")])))
    assert [(r.n, r.keep) for r in index.classes().collect()] == [(2, 2)]


def test_hot_text_is_joined_by_broadcast(spark):
    docs = documents(spark, [(i, "same" if i % 3 == 0 else f"text {i}", "s") for i in range(3000)])
    found = cuckoo.exact_dedup(docs)
    assert found.filter("group_size = 1000").count() == 1000
    assert found.filter("kept").count() == 2001
