import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm import best_fit_packing as packing
from pairloom.llm.common import Scratch
from tests.llm.helpers import awkward

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def occupied(plan):
    places, ranks = {}, {}
    for length, lo, hi, sequence, offset, each in plan.runs:
        for r in range(lo, hi):
            place = (offset + (r - lo) % each * length, length)
            places.setdefault(sequence + (r - lo) // each, []).append(place)
            ranks.setdefault(length, []).append(r)
    return places, ranks


@pytest.mark.parametrize("share", packing.SMALL_SHARES)
@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece_once_without_gaps(share, seed):
    pick = random.Random(seed)
    histogram = {pick.randint(1, 100): pick.randint(1, 30) for _ in range(pick.randint(1, 60))}
    plan = packing.Plan(histogram, 100, 8, share)
    places, ranks = occupied(plan)
    assert {n: sorted(r) for n, r in ranks.items()} == {
        n: list(range(c)) for n, c in histogram.items()
    }
    assert sorted(places) == list(range(plan.sequences))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 100


def test_a_hot_length_is_a_handful_of_runs():
    plan = packing.Plan({1: 10**9, 1500: 10**6, 700: 10**6}, 2048, 8, 0.25)
    assert len(plan.runs) < 50
    assert plan.sequences <= 1.001 * (10**9 + 2200 * 10**6) / 2048 + 2


def test_configurations_reach_the_optimum_of_a_known_case():
    # 30 of 60, 30 of 40: thirty sequences of 100.
    found = packing.configurations([60, 40], [30, 30], 100)
    assert sum(times for _, times in found) == pytest.approx(30)


def test_empty_histogram():
    assert packing.Plan({}, 2048, 8, 0.25).runs == []


def test_both_libraries_give_the_same_ids():
    encoder = packing.Encoder(JSON, RANKS, public_tokenizers.PATTERN)
    exact = Tokenizer.from_file(JSON)
    texts = [
        "", " ", "\n\n  x", "It's 12,345 o'clock; we'll go!!  ", "naïve Übung ça ñandú\t\r\n",
        "日本語 text", "emoji 😀 and ́ marks", "x<|endoftext|>y", "a" * 5000, "\x00\x01\x1f\x85",
    ]
    for text in texts:
        assert encoder.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_awkward_documents_round_trip(spark):
    docs = awkward(spark)
    pieces = packing.token_pieces(docs, JSON, RANKS, public_tokenizers.PATTERN)
    found = packing.pack(pieces, Scratch(spark, "test"), bucket_rows=2).toPandas()
    exact = Tokenizer.from_file(JSON)
    wanted = []
    for row in docs.collect():
        ids = np.array(exact.encode(row.text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            id_ = -1 if row.doc_id is None else row.doc_id
            wanted.append((id_, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    columns = ["id", "piece", "start", "length", "ids_crc32"]
    got = [tuple(map(int, row)) for row in found[columns[1:]].to_numpy()]
    assert sorted(got) == sorted(row[1:] for row in wanted)
    ids = [r.id for r in pieces.select("id").collect()]
    assert sorted(-1 if i is None else i for i in ids) == sorted(row[0] for row in wanted)
    for _, items in found.groupby("sequence_id"):
        items = items.sort_values("offset")
        assert (items["offset"] == items["length"].cumsum() - items["length"]).all()
        assert items["length"].sum() <= 2048
    total = -(-found["length"].sum() // 2048)
    assert found["sequence_id"].nunique() == total


def test_empty_table(spark):
    pieces = packing.token_pieces(awkward(spark).limit(0), JSON)
    assert packing.pack(pieces, Scratch(spark, "test")).count() == 0
