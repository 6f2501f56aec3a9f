import random
import re

import pytest

from pairloom.llm import fuzzy_lines as fuzzy
from pairloom.llm.common import TEXT_ROWS, Scratch, narrow_batches, text_batches
from tests.llm.helpers import awkward, components, documents, rows_of


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bounded_edit_distance():
    pick = random.Random(5)
    for _ in range(2000):
        a = "".join(pick.choice("abé") for _ in range(pick.randint(0, 12)))
        b = "".join(pick.choice("abé") for _ in range(pick.randint(0, 12)))
        wanted = distance(a, b)
        for most in range(max(wanted - 2, 0), wanted + 3):
            assert fuzzy._within(a.encode(), b.encode(), most) == (wanted <= most)


def normal(line):
    return re.sub("[^a-z0\x80-\U0010ffff]+", " ", re.sub(r"\d", "0", ascii_lower(line))).strip()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_groups_equal_brute_force(spark, monkeypatch):
    pick = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    base = [" ".join(pick.choice(words) for _ in range(150)) for _ in range(12)]
    docs = []
    for i in range(30):
        lines = []
        for _ in range(4):
            line = pick.choice(base).split()
            if pick.random() < 0.6:
                line[pick.randrange(150)] = pick.choice(words)
            lines.append(" ".join(line).replace("wa", pick.choice(["Wa", "wa"])))
        docs.append((i, "\n".join(lines) + "\n--\n", "s"))
    monkeypatch.setattr(fuzzy, "TILE", 3)
    table = documents(spark, docs)
    found = rows_of(fuzzy.fuzzy_line_dedup(table), "doc_id", "line", "keep_id", "keep_line")
    again = fuzzy.fuzzy_line_dedup(table, blocks=6)
    assert found == rows_of(again, "doc_id", "line", "keep_id", "keep_line")

    places, prints = [], []
    make = fuzzy._lines_of()
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"id": [d for d, _, _ in docs], "text": [t for _, t, _ in docs]}
    )
    for out in make(iter([batch])):
        for r in out.to_pylist():
            places.append((r["id"], r["line"], r["norm"].decode()))
            prints.append(r["print"] % (1 << 64))
            text = docs[r["id"]][1]
            assert normal(text[r["start"] : r["end"]]) == r["norm"].decode()

    def linked(i, j):
        a, b = places[i][2], places[j][2]
        near = (prints[i] ^ prints[j]).bit_count() <= 3
        return near and distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)

    roots = components(len(places), linked)
    wanted = [
        (*places[i][:2], *places[r][:2]) for i, r in enumerate(roots) if i != r
    ]
    assert found == sorted(wanted)
    assert len({places[i][2] for i in range(len(places))}) > len(set(roots))


def test_similar_prints_of_different_texts_are_not_joined(spark):
    docs = documents(spark, [(1, "alpha", "s"), (2, "beta", "s")])
    assert fuzzy.fuzzy_line_dedup(docs, most_different=3).count() == 0


@pytest.mark.parametrize("rows", [0, 11])
def test_awkward_documents(spark, rows):
    found = fuzzy.fuzzy_line_dedup(awkward(spark).limit(rows) if not rows else awkward(spark))
    wanted = [] if not rows else [(4, 0, 1, 0), (4, 0, 1, 0), (2**60 + 1, 0, 2**60, 0)]
    assert rows_of(found, "doc_id", "line", "keep_id", "keep_line") == wanted


def test_hot_lines_meet_their_group(spark):
    rows = [(i, f"The same footer, {i}!\nrow {chr(97 + i % 26)}{'y' * i}", "s") for i in range(1, 300)]
    found = fuzzy.fuzzy_line_dedup(documents(spark, rows)).filter("line = 0")
    kept = {r.keep_id: r["count"] for r in found.groupBy("keep_id").count().collect()}
    assert kept == {1: 8, 10: 89, 100: 199}  # digits count as one another


def test_prints_of_lines_of_any_length():
    import pyarrow as pa
    import xxhash

    pick = random.Random(8)
    words = ["".join(pick.choice("abcdefg") for _ in range(4)) for _ in range(40)]
    lines = [" ".join(pick.choice(words) for _ in range(n)) for n in (1, 2, 254, 255, 256, 700, 3)]
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["\n".join(lines)]})
    (out,) = fuzzy._lines_of()(iter([batch]))
    for line, print_ in zip(lines, out.column("print").to_pylist()):
        hashes = [xxhash.xxh64_intdigest(w) for w in line.encode().split()]
        pairs = [(a * 0x9E3779B97F4A7C15 ^ b) % (1 << 64) for a, b in zip(hashes, hashes[1:])]
        features = [*pairs, hashes[-1]]
        wanted = sum(
            1 << b for b in range(64) if 2 * sum(f >> b & 1 for f in features) > len(features)
        )
        assert print_ % (1 << 64) == wanted


def test_tiles_are_told_apart_in_one_stream():
    """Small tiles follow one another in the same batches, and may be cut by their ends."""
    import pyarrow as pa

    text = "some words that are long enough to be edited a little"
    rows = []
    for k in range(50):  # component k: two alike, one other, all of one print
        lines = [text + chr(97 + k % 26), text + "!", "other"]
        rows += [(k, 0, 0, 0, b"%03d%d" % (k, n), k, line.encode()) for n, line in enumerate(lines)]
    rows += [(99, 0, 1, n % 2, b"999%d" % n, 7, text.encode()) for n in range(4)]  # two blocks
    names = fuzzy.TILE_COLUMNS
    batches = [
        pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows[at : at + 7])))))
        for at in range(0, len(rows), 7)
    ]
    (out,) = fuzzy._verify(3, 0.8)(iter(batches))
    found = [(r["u"], r["v"]) for r in out.to_pylist()]
    assert found[:50] == [(b"%03d0" % k, b"%03d1" % k) for k in range(50)]
    assert found[50:] == [(b"9990", b"9991"), (b"9990", b"9993"), (b"9992", b"9991")]
    assert list(fuzzy._verify(3, 0.8)(iter([]))) == []


def test_lines_that_stand_alone_are_left_out_of_groups(spark):
    rows = [(1, "one line here\nanother thing entirely\nthe footer", "s"), (2, "the footer", "s")]
    docs = documents(spark, rows).selectExpr("doc_id as id", "text")
    scratch = Scratch(spark, "test")
    lines = scratch.write(docs.mapInArrow(fuzzy._lines_of(), fuzzy.SCHEMA), "lines")
    assert rows_of(fuzzy.line_groups(lines, scratch, 5, 3, 0.8), "id", "n") == [(1, 2)]


def test_numbers_go_to_workers_in_larger_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    text_batches(spark)
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), narrow_batches(spark):
        assert int(spark.conf.get(key)) > TEXT_ROWS
        1 / 0
    assert spark.conf.get(key) == before


def test_texts_with_all_kinds_of_space(spark):
    import pyarrow as pa

    pick = random.Random(9)
    signs = [" ", "  ", "\n", "\t", "a", "B", "é", "\x00", "\x85", "\xa0", "9", ".", "漢", "\r", "\x1c"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randrange(80))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(202)), "text": [*texts, None, "ab " * 600]})
    (out,) = fuzzy._lines_of()(iter([batch]))
    found = [(r["id"], r["line"], r["norm"].decode()) for r in out.to_pylist()]
    plain = lambda line: re.sub("[^a-z0\x80-\U0010ffff]+", " ", line.lower().replace("9", "0"))
    assert found[:-1] == [
        (i, n, plain(line).strip(" "))
        for i, text in enumerate(texts)
        for n, line in enumerate(text.split("\n"))
        if plain(line).strip(" ")
    ]
    assert found[-1] == (201, 0, " ".join(["ab"] * 600))


def test_more_candidates_than_can_be_broadcast(spark, monkeypatch):
    pick = random.Random(10)
    base = [" ".join(f"w{chr(97 + pick.randrange(26))}{chr(97 + k)}" for _ in range(80)) for k in range(6)]
    rows = [
        (i, "\n".join(f"{pick.choice(base)} {pick.choice(['', 'end', 'last', 'q' * i])}" for _ in range(3)), "s")
        for i in range(40)
    ]
    found = []
    for most in (fuzzy.IDS_TO_BROADCAST, 0):
        monkeypatch.setattr(fuzzy, "IDS_TO_BROADCAST", most)
        removed = fuzzy.fuzzy_line_dedup(documents(spark, rows))
        found.append(rows_of(removed, *removed.columns))
    assert found[0] == found[1] and len(found[0]) > 40
