"""Integer product quantisation against whole comparison, and its defined cases."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import walsh_codes
from tests.llm.helpers import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int, id string, code string, error int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1, 2) for r in rows], SCHEMA).repartition(3)


def brute_force(rows, parts=4, entries=256, rounds=4):
    """Plain whole-number arithmetic over sorted rows; `(id, code, error, label_error)`."""
    kept = [
        (i, [int(np.floor(1024 * x)) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max((len(v) for _, v, _ in kept), default=0)
    size = max(1, -(-width // parts))
    cut = [[(v + [0] * (parts * size))[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def closest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        moved = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(closest(c[p], books[p])[1], []).append(c[p])
            for k, m in members.items():
                moved[p][k] = [sum(x) // len(m) for x in zip(*m)]
        books = moved
    out = []
    for (i, _, label), c in zip(kept, cut):
        best = [closest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    sums = {}
    for _, _, e, label in out:
        sums[label] = sums.get(label, 0) + e
    numbers = ",".join(str(x) for b in books for e in b for x in e)
    return [(i, c, e, sums[label]) for i, c, e, label in out], hashlib.sha256(numbers.encode()).hexdigest()


def check(spark, rows, **options):
    found = walsh_codes.compressed(vectors(spark, rows), **options)
    wanted, sha = brute_force(rows, **options)
    key = lambda r: tuple((v is None, v) for v in r)
    assert rows_of(found, "id", "code", "error", "label_error") == sorted(wanted, key=key)
    assert {r[0] for r in found.select("codebooks_sha256").collect()} == ({sha} if wanted else set())


def test_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(20)], rng.choice([None, 1, 2])) for i in range(120)]
    check(spark, rows, entries=16)


def test_clusters_ties_and_copies(spark):
    rng = random.Random(4)
    centres = [[rng.choice([-0.5, 0.0, 0.5]) for _ in range(8)] for _ in range(5)]
    rows = [(i, [x + rng.choice([0.0, 0.01]) for x in rng.choice(centres)], 1) for i in range(90)]
    check(spark, rows + rows[:20], entries=7)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0], 1), (4, [inf, 0.0], 2),
        (5, [], 1), (6, [0.5, -0.25, 3.0], None), (7, [0.5] * 9, None), (None, [1.0] * 4, 2),
        (8, [-0.0001] * 5, None), (8, [-0.0001] * 5, None), (9, [1e5, -1e5], 3), (10, [2.0**40, 0.5], 4),
    ]
    check(spark, rows, entries=3)
    check(spark, rows[:4])
    check(spark, [])


def test_error_beyond_a_long_is_null(spark):
    rows = [(1, [0.0] * 4, 1), (2, [2.0**45] * 4, 1), (3, [1.0] * 4, 2)]
    found = walsh_codes.compressed(vectors(spark, rows), entries=1, rounds=0)
    assert rows_of(found, "id", "error", "label_error") == [(1, 0, None), (2, None, None), (3, 4 * 1024**2, 4 * 1024**2)]


def test_float_vectors_and_too_many_entries(spark):
    rows = [(i, [i / 7, -i / 3], 1) for i in range(9)]
    narrow = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    wanted, _ = brute_force([(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows], entries=4)
    assert rows_of(walsh_codes.compressed(narrow, entries=4), "id", "code", "error", "label_error") == wanted
    with pytest.raises(ValueError):
        walsh_codes.compressed(narrow, entries=300)


def test_transform_is_in_sequency_order():
    for n in (1, 2, 4, 16, 64):
        rows = walsh_codes.walsh(np.eye(n, dtype=np.int64)).T
        assert (rows @ rows.T == n * np.eye(n)).all()
        assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(n))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 20), st.integers(0, 2**62), st.integers(1, 2**33))
def test_search_is_exact(width, seed, largest):
    rng = np.random.default_rng(seed)
    parts = rng.integers(-largest, largest + 1, (30, width))
    entries = np.concatenate([rng.integers(-largest, largest + 1, (9, width)), parts[:3], parts[:3]])
    exact = ((parts.astype(object)[:, None] - entries.astype(object)[None]) ** 2).sum(axis=2)
    index, distance = walsh_codes.nearest(parts, entries)
    assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
