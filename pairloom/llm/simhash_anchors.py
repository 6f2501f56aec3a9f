"""SimHash near-dedup by anchor-point covering.

Fingerprints are covered by the words of a code. The anchors are the codewords of the
perfect Hamming code of 31 bits, whose covering radius is 1: every point has an anchor
within 1, so a point within k of it has that anchor within 1 + k. Replicating each
fingerprint to all anchors within 1 + k therefore brings every pair within k together.
Of two fingerprints that differ in at most 2 of 64 bits, either the lower 31 bits differ in
at most 1 bit or the upper 33 bits not at all. So the code is laid over both parts: over
the lower 31 bits with k = 1 (16 anchors at most), and over the upper 33, two of which are
taken as they are, with k = 0 (one anchor). That makes 17 rows a fingerprint, instead of
more than 600 over all 64 bits at once. Each anchor's fingerprints are then compared.

Equal fingerprints are grouped before, so copies are one row. Rows of one anchor arrive
sorted and are compared as arrays; only links that join two trees of a group are put out,
never all pairs. Anchors with more than `most_per_anchor` fingerprints are left to an exact
second way: two fingerprints within 2 bits agree in six of their eight bytes at least, so
their rows are dealt by each choice of six bytes, which leaves at most 2^16 to compare.

Defined cases: words are runs of bytes other than white space, A-Z lower-cased. Fewer words
than a shingle count as one shingle; no word (null or empty text) gives fingerprint zero,
which links like any other. Repeated rows share a class. A null id is in its class but does
not name it; the class is null if all its ids are. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, lookup, text_batches, without_ids
from pairloom.llm.components import connected_components

SEED = 42
LOW_BITS = 31
MOST_DIFFERENT = 2
WORDS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 17


def _fingerprints(shingle: int):
    import numpy as np
    import pyarrow as pa
    import xxhash

    def words_of(data: bytes) -> Iterator[list[bytes]]:
        while data:
            words = data.split(None, WORDS_AT_ONCE)
            data = words.pop() if len(words) > WORDS_AT_ONCE else b""
            if words:
                yield words

    def counted(hashes: list[int]):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8))
        return bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)

    def one(text: str | None) -> int:
        digest, n, counts, carried = xxhash.xxh64_intdigest, 0, np.zeros(64, np.int64), []
        for words in words_of((text or "").encode("utf-8").lower()):
            words = carried + words
            rows = zip(*(words[i:] for i in range(shingle)))
            if hashes := [digest(row, SEED) for row in map(b" ".join, rows)]:
                counts += counted(hashes)
                n += len(hashes)
            carried = words[-(shingle - 1) :] if shingle > 1 else []
        if not n and carried:
            return digest(b" ".join(carried), SEED)
        return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")

    def batches(parts: Iterator) -> Iterator:
        for part in parts:
            prints = np.array([one(t.as_py()) for t in part.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(prints.view(np.int64))], ["id", "print"]
            )

    return batches


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(id, print)`: the 64-bit SimHash of all shingles of each whole text, as a long."""
    text_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    ).mapInArrow(_fingerprints(shingle), "id long, print long")


def _syndrome(word: Column) -> Column:
    """Of a 31-bit word in the Hamming code: the place (from 1) of the bit to flip for the
    nearest codeword, 0 for a codeword."""
    found = F.lit(0)
    for j in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> j & 1)
        parity = F.bit_count(word.bitwiseAND(F.lit(mask).cast("long"))) % 2
        found = found + parity * (1 << j)
    return found


def _flipped(word: Column, place: Column) -> Column:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))
    return F.when(place == 0, word).otherwise(word.bitwiseXOR(bit))


def anchors(print_: Column) -> Column:
    """Keys of all anchors of a fingerprint: those of the lower part are even numbers."""
    ones = F.lit((1 << LOW_BITS) - 1).cast("long")
    low, high = print_.bitwiseAND(ones), F.shiftrightunsigned(print_, LOW_BITS)
    s = _syndrome(low)
    nearest = _flipped(low, s)
    # Codewords at distance 2 differ in two places whose numbers give the syndrome.
    first = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: i.bitwiseXOR(s) > i)
    further = F.transform(first, lambda i: _flipped(_flipped(low, i), i.bitwiseXOR(s)))
    raw = high.bitwiseAND(F.lit(3 << LOW_BITS).cast("long"))
    high_31 = high.bitwiseAND(ones)
    upper = _flipped(high_31, _syndrome(high_31)).bitwiseOR(raw)
    lower = F.transform(F.concat(F.array(nearest), further), lambda a: a * 2)
    return F.concat(lower, F.array(upper * 2 + 1))


def _six_bytes(print_: Column) -> Column:
    """Keys of each choice of six of the eight bytes."""
    keys = []
    for k, bytes_ in enumerate(combinations(range(8), 6)):
        mask = sum(255 << 8 * b for b in bytes_)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(print_.bitwiseAND(F.lit(mask).cast("long")), F.lit(k)))
    return F.array(*keys)


def _compare(most_different: int):
    import numpy as np
    import pyarrow as pa

    def forest(keys, prints):
        """Links within each run of equal keys, without those that close a ring."""
        parent = np.arange(len(keys))
        bits = prints.view(np.uint64)  # of signed numbers, the bits of the amount are counted
        found: list[tuple[int, int]] = []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        here = np.arange(len(keys) - 1)
        step = 1
        while len(here):
            here = here[keys[here] == keys[here + step]]
            near = np.bitwise_count(bits[here] ^ bits[here + step]) <= most_different
            a = here[near]
            a = a[parent[a] != parent[a + step]]
            for i, j in zip(a.tolist(), (a + step).tolist()):
                if (x := root(i)) != (y := root(j)):
                    parent[max(x, y)] = min(x, y)
                    found.append((i, j))
            if len(a):
                while (parent != parent[parent]).any():
                    parent[:] = parent[parent]
            step += 1
            here = here[here + step < len(keys)]
        at = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[at[:, 0]]), pa.array(prints[at[:, 1]])], ["u", "v"]
        )

    def batches(parts: Iterator) -> Iterator:
        keys, prints, rows, enough = [], [], 0, ROWS_AT_ONCE
        for part in parts:
            keys.append(part.column("key").to_numpy())
            prints.append(part.column("print").to_numpy())
            rows += part.num_rows
            if rows < enough:
                continue
            key, print_ = np.concatenate(keys), np.concatenate(prints)
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
            yield forest(key[:cut], print_[:cut])
            keys, prints, rows = [key[cut:]], [print_[cut:]], len(key) - cut
            enough = max(ROWS_AT_ONCE, 2 * rows)
        if rows:
            yield forest(np.concatenate(keys), np.concatenate(prints))

    return batches


def links_within_keys(keyed: DataFrame, most_different: int = MOST_DIFFERENT) -> DataFrame:
    """`(u, v)`: links that connect the prints of each key that differ in so few bits;
    `keyed` is `(key, print)`."""
    return (
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_compare(most_different), "u long, v long")
    )


def near_links(prints: DataFrame, scratch: Scratch, most_per_anchor: int = 4096) -> DataFrame:
    """`(u, v)`: links that connect all fingerprints within two bits; `prints` is
    distinct."""
    keyed = prints.select(F.explode(anchors(F.col("print"))).alias("key"), "print")
    crowded = scratch.write(
        keyed.groupBy("key").count().filter(F.col("count") > most_per_anchor).select("key"),
        "crowded",
    )
    if crowded.isEmpty():
        return links_within_keys(keyed)
    dense = keyed.join(crowded, "key", "left_semi").select("print").distinct()
    by_bytes = dense.select(F.explode(_six_bytes(F.col("print"))).alias("key"), "print")
    return links_within_keys(keyed.join(crowded, "key", "left_anti")).unionByName(links_within_keys(by_bytes))


def simhash_classes(
    docs: DataFrame,
    shingle: int = 3,
    most_per_anchor: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: `(doc_id, fingerprint, component_id)`.

    `component_id` is the smallest id that is reached over fingerprints within two bits.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    printed = scratch.write(fingerprints(docs, shingle, id_col, text_col), "prints")
    groups = scratch.write(
        printed.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")),
        "groups",
    )
    links = near_links(groups.select("print"), scratch, most_per_anchor)
    joined = connected_components(links, scratch).withColumnRenamed("node", "print")
    placed = groups.join(joined, "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    placed = scratch.write(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("print", "n", "component_id")
    return lookup(printed, named, "print", "n").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_copies(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one document of each class, that with the smallest id.

    Rows that share an id stay if it is the smallest of any of their classes. Rows without
    an id stay.
    """
    scratch = Scratch(docs.sparkSession, "near")
    classes = simhash_classes(docs, shingle, id_col=id_col, text_col=text_col)
    stays = F.max(F.col(id_col) == F.col("component_id"))
    dropped = (
        classes.groupBy(F.col(id_col).alias("id")).agg(stays.alias("stays")).filter("not stays")
    )
    return without_ids(docs, scratch.write(dropped.select("id"), "dropped"), id_col)
