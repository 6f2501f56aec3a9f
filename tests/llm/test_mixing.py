import hashlib
import math

import pytest

from pairloom.llm import mixing
from pairloom.llm.mixing import Mix, Target
from tests.llm.helpers import awkward, documents, rows_of

SIZES = {"big": 300, "mid": 90, "low": 30}


def corpus(spark):
    rows, i = [], 0
    for source, n in SIZES.items():
        for k in range(n):
            rows.append((i, "x" * (40 + 13 * k % 170), source))
            i += 1
    return rows, documents(spark, rows)


def hashed(*parts):
    return int(hashlib.md5("/".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def brute_force(rows, alpha, budget, block_tokens, seed=1):
    tokens = {i: max(1, math.ceil(len(t) / 4)) for i, t, _ in rows}
    total = {}
    for i, _, s in rows:
        total[s] = total.get(s, 0) + tokens[i]
    z = sum(t**alpha for t in total.values())
    weight = {s: t**alpha / z for s, t in total.items()}
    budget = budget or max(t / weight[s] for s, t in total.items())
    out = []
    for s, t in total.items():
        quota, n = weight[s] * budget, max(1, math.ceil(t / block_tokens))
        blocks = {}
        for i, _, source in rows:
            if source == s:
                blocks.setdefault(hashed(i, seed) % n, []).append(i)
        size = {b: sum(tokens[i] for i in ids) for b, ids in blocks.items()}
        for turn in range(max(1, math.ceil(quota / t))):
            start = turn * t
            for b in sorted(blocks, key=lambda b: (hashed("=" + s, turn, b, seed), b)):
                if start + size[b] / 2 <= quota:
                    out += [(i, turn, b, math.floor(start / quota * 1e6 + 0.5)) for i in blocks[b]]
                start += size[b]
    return sorted(out)


@pytest.mark.parametrize("budget", [None, 9000.0])
def test_draws_equal_brute_force(spark, budget):
    rows, docs = corpus(spark)
    mix = Mix(Target("repetition", 2.5), budget, block_tokens=200)
    total = {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + max(1, math.ceil(len(t) / 4))
    if budget is None:
        alpha = 1 - math.log(2.5) / math.log(max(total.values()) / min(total.values()))
    else:
        low, high = 0.0, 1.0
        for _ in range(200):
            mid = (low + high) / 2
            z = sum(t**mid for t in total.values())
            low, high = (low, mid) if max(budget * t ** (mid - 1) / z for t in total.values()) <= 2.5 else (mid, high)
        alpha = high
    found = rows_of(mixing.draws(docs, mix), "doc_id", "pass", "block", "position")
    assert found == brute_force(rows, alpha, budget, 200)


def test_no_document_is_lost_and_none_is_drawn_too_often(spark):
    _, docs = corpus(spark)
    drawn = mixing.draws(docs, Mix(Target("repetition", 2.0), block_tokens=200))
    times = {r.doc_id: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
    assert set(times) == set(range(420)) and max(times.values()) == 2


def test_entropy_target(spark):
    _, docs = corpus(spark)
    wanted = 0.8
    mix = Mix(Target("entropy", wanted), budget=40_000, block_tokens=100)
    sums = [r["sum(tokens)"] for r in mixing.draws(docs, mix).groupBy("source_key").sum("tokens").collect()]
    shares = [s / sum(sums) for s in sums]
    assert -sum(p * math.log(p) for p in shares) == pytest.approx(wanted, abs=0.01)
    assert sum(sums) == pytest.approx(40_000, rel=0.01)


def test_rows_are_repeated_as_often_as_they_are_drawn(spark):
    _, docs = corpus(spark)
    mix = Mix(Target("repetition", 2.0), block_tokens=150)
    drawn = mixing.draws(docs, mix).groupBy("doc_id").count()
    mixed = mixing.mixed(docs, mix)
    assert mixed.columns == docs.columns
    assert rows_of(mixed.groupBy("doc_id").count(), "doc_id", "count") == rows_of(drawn, "doc_id", "count")


def test_awkward_documents(spark):
    docs = awkward(spark)
    mix = Mix(Target("repetition", 3.0), block_tokens=5)
    drawn = rows_of(mixing.draws(docs, mix), "doc_id", "source_key")
    assert set(drawn) == {(r.doc_id, "" if r.source is None else "=" + r.source) for r in docs.collect()}
    mixed = mixing.mixed(docs, mix)
    assert mixed.count() == len(drawn) and mixed.columns == docs.columns
    assert mixing.draws(docs.limit(0), mix).count() == 0
    assert mixing.mixed(docs.limit(0), mix).count() == 0


def test_one_source_and_a_limit_that_cannot_be_met(spark):
    docs = documents(spark, [(i, "word " * 8, "s") for i in range(20)])
    mix = Mix(Target("repetition", 2.0), budget=1e9, block_tokens=20)
    assert mixing.draws(docs, mix).count() == 40


def test_unknown_target():
    with pytest.raises(ValueError):
        Target("variance", 1.0)


def test_no_python_in_the_plan(spark, sf_dir):
    from pairloom.llm import queries

    plan = queries.op1_temperature_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
