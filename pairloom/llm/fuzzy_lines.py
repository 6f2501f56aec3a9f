"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, connected groups.

Lines are normalised (A-Z lower-cased, digits to 0, ASCII marks to spaces, spaces run
together). Equal lines are one row from there on. Each gets a SimHash of its pairs of
neighbouring words; of single words, long lines of one language would all look alike. Two fingerprints within `most_different` bits leave at least `blocks -
most_different` of their `blocks` blocks equal, so all fingerprints are dealt by every choice
of that many blocks and compared within it. Lines whose fingerprints are connected are
candidates; their texts are compared in tiles of `TILE` by `TILE` lines, so a candidate set
of any size is shared by many tasks. Two lines are linked if their fingerprints are within
`most_different` bits and their edit similarity, 1 - distance / longer length, is at least
`similarity`; pairs that are connected already are not compared again, which cannot change
a group. Of each connected group of lines the earliest occurrence stays.

Text is written once and read back only for candidates. Occurrences meet their group by a
join that bears a line which a third of all documents share.

Defined cases: lines without a letter, digit or non-ASCII character are left alone. The
earliest occurrence is that in the smallest id, then the first in the text; a null id comes
last. Rows that share an id are one document: equal lines at the same number in both stay.
Null and empty texts have no lines. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import IDS_TO_BROADCAST, Scratch, lookup, narrow_batches, text_batches
from pairloom.llm.components import connected_components
from pairloom.llm.simhash_anchors import links_within_keys

TILE = 256
NO_ID = (1 << 63) - 1
PARTS_AT_ONCE = 512  # of up to 255 words; their bits stay in the processor's cache
LINKS_AT_ONCE = 10_000
TILE_COLUMNS = ("component", "tile_row", "tile_column", "block", "digest", "print", "norm")
SCHEMA = "id long, line int, start long, end long, digest binary, print long, norm binary"


def _normalising_table() -> bytes:
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = bytes(range(97, 123))
    table[ord("0") : ord("9") + 1] = b"0" * 10
    return bytes(table)


def _lines_of():
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    table = _normalising_table()
    names = ["id", "line", "start", "end", "digest", "print", "norm"]

    def hashed(words: pa.Array):
        """The hash of every word; a word that occurs again in the batch is hashed once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), "<u8", len(distinct))
        return hashes[coded.indices.to_numpy()]

    def prints_of(lines: pa.Array):
        """SimHash of the pairs of neighbouring words of each line, and its last word."""
        sizes = pc.list_value_length(lines).to_numpy().astype(np.int64)
        first = np.cumsum(sizes) - sizes
        words = hashed(lines.flatten())
        pairs = words.copy()
        pairs[:-1] = words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:]
        pairs[first + sizes - 1] = words[first + sizes - 1]
        # Eight counts are added as one number; 255 bits leave no carry between them.
        parts = -(-sizes // 255)
        begins = np.cumsum(parts) - parts
        within = np.arange(parts.sum()) - np.repeat(begins, parts)
        starts = np.repeat(first, parts) + 255 * within
        counts = []
        for k in range(0, len(starts), PARTS_AT_ONCE):
            here = starts[k : k + PARTS_AT_ONCE + 1]
            stop = here[-1] if len(here) > PARTS_AT_ONCE else len(pairs)
            bits = np.unpackbits(pairs[here[0] : stop].view(np.uint8), bitorder="little")
            bits, here = bits.view(np.uint64).reshape(-1, 8), here[:PARTS_AT_ONCE] - here[0]
            counts.append(np.add.reduceat(bits, here, axis=0))
        counts = np.concatenate(counts).view(np.uint8)
        counts = np.add.reduceat(counts, begins, axis=0, dtype=np.int32)
        return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<i8")[:, 0]

    def batches(parts: Iterator) -> Iterator:
        for part in parts:
            at, rows, lines = [], [], []
            for k, text in enumerate(part.column("text").to_pylist()):
                start = 0
                for number, line in enumerate((text or "").split("\n")):
                    end = start + len(line)
                    if norm := line.encode().translate(table).strip():
                        at.append(k)
                        rows.append((number, start, end))
                        lines.append(norm)
                    start = end + 1
            if not rows:
                continue
            number, start, end = zip(*rows)
            words = pc.ascii_split_whitespace(pa.array(lines, pa.binary()).cast(pa.string()))
            norm = pc.binary_join(words, " ").cast(pa.binary())
            digest = map(xxhash.xxh3_128_digest, norm.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(at, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(prints_of(words)),
                    norm,
                ],
                names,
            )

    return batches


def block_keys(print_: Column, blocks: int, most_different: int) -> Column:
    """A key for every choice of `blocks - most_different` blocks of the fingerprint."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - most_different)):
        mask = sum((1 << edges[b + 1]) - (1 << edges[b]) for b in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(print_.bitwiseAND(F.lit(mask).cast("long")), F.lit(number)))
    return F.array(*keys)


def _alike(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _within(a: bytes, b: bytes, most: int) -> bool:
    """Is the edit distance at most `most`? Bit-parallel over the characters of the shorter
    text, after what both begin and end with is taken off."""
    x, y = a.decode(), b.decode()
    start = _alike(x, y)
    x, y = x[start:][::-1], y[start:][::-1]
    end = _alike(x, y)
    x, y = x[end:], y[end:]
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > most:
        return False
    if len(x) <= most:  # no more edits than characters of the longer text
        return True
    if not y:
        return False
    places: dict[str, int] = {}
    for i, c in enumerate(y):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(y)) - 1, 1 << len(y) - 1
    up, down, distance, left = full, 0, len(y), len(x)
    for c in x:
        match = places.get(c, 0)
        vertical = match | down
        across = (((match & up) + up) ^ up) | match
        higher, lower = (down | ~(across | up)) & full, up & across
        left -= 1
        if higher & top:
            distance += 1
        elif lower & top:
            distance -= 1
        if distance - left > most:
            return False
        higher, lower = (higher << 1 | 1) & full, (lower << 1) & full
        up, down = (lower | ~(vertical | higher)) & full, higher & vertical
    return distance <= most


def _verify(most_different: int, similarity: float):
    """Links of tiles whose rows `TILE_COLUMNS` follow one another, each in order of digests."""
    import numpy as np
    import pyarrow as pa

    def tile(row: int, column: int, lines: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        """Links of one tile: lines of the row block with those of the column block."""
        rows = [line for line in lines if line[3] == row]
        columns = [line for line in lines if line[3] == column]
        parent: dict[bytes, bytes] = {}

        def root(d: bytes) -> bytes:
            while parent.setdefault(d, d) != d:
                parent[d] = parent[parent[d]]
                d = parent[d]
            return d

        left, right = (np.array([x[5] for x in part]).view(np.uint64) for part in (rows, columns))
        near = np.bitwise_count(left[:, None] ^ right) <= most_different
        if row == column:  # both blocks are one: each pair once
            near = np.triu(near, 1)
        for i, j in zip(*(at.tolist() for at in np.nonzero(near))):
            (digest, _, norm), (other, _, other_norm) = rows[i][4:], columns[j][4:]
            a, b = root(digest), root(other)
            if a == b:
                continue
            longer = max(len(norm.decode()), len(other_norm.decode()))
            if _within(norm, other_norm, int((1 - similarity) * longer + 1e-9)):
                parent[max(a, b)] = min(a, b)
                yield digest, other

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, pa.binary()) for column in zip(*found)]
        return pa.RecordBatch.from_arrays(columns, ["u", "v"])

    def batches(parts: Iterator) -> Iterator:
        found = []
        columns = ([part.column(name).to_pylist() for name in TILE_COLUMNS] for part in parts)
        rows = chain.from_iterable(zip(*part) for part in columns)
        for (_, row, column), lines in groupby(rows, itemgetter(0, 1, 2)):
            found += tile(row, column, list(lines))
            if len(found) >= LINKS_AT_ONCE:
                yield batch(found)
                found = []
        if found:
            yield batch(found)

    return batches


def line_groups(
    lines: DataFrame, scratch: Scratch, blocks: int, most_different: int, similarity: float
) -> DataFrame:
    """`(digest, group, id, n)` of every distinct line that is linked or occurs again, which
    are those that can go or stay for others; `group` is the smallest digest."""
    distinct = scratch.write(
        lines.groupBy("digest").agg(
            F.max("print").alias("print"), F.min("id").alias("id"), F.count(F.lit(1)).alias("n")
        ),
        "distinct",
    )
    prints = scratch.write(
        distinct.groupBy("print").agg(F.count(F.lit(1)).alias("digests")), "prints"
    )
    keyed = prints.select(
        F.explode(block_keys(F.col("print"), blocks, most_different)).alias("key"), "print"
    )
    with narrow_batches(scratch.spark):
        near = connected_components(links_within_keys(keyed, most_different), scratch)
    # Only prints with a neighbour or with more than one line make candidates; all other lines
    # are read once and not shuffled while these prints can be broadcast.
    near = near.withColumnRenamed("node", "print")
    near = near.join(prints.filter("digests > 1"), "print", "full").select(
        "print",
        F.coalesce("component", "print").alias("component"),
        F.coalesce("digests", F.lit(1)).alias("digests"),
    )
    near = scratch.write(near, "near")
    sizes = near.groupBy("component").agg(
        F.sum("digests").alias("m"), F.count(F.lit(1)).alias("prints")
    )
    sizes = lookup(near, scratch.write(sizes, "sizes"), "component", "prints")
    placed = scratch.write(sizes.select("print", "component", "m"), "placed")
    if placed.count() <= IDS_TO_BROADCAST // 4:  # of three numbers
        placed = F.broadcast(placed)
    candidates = distinct.join(placed, "print", "left").filter("component is not null or n > 1")
    candidates = scratch.write(candidates, "candidates")
    # Digests are spread evenly, so a slice of them cuts a component into even blocks.
    block = F.pmod(F.xxhash64("digest"), F.ceil(F.col("m") / TILE)).cast("int")
    members = candidates.filter("component is not null").withColumn("block", block)
    members = members.drop("id", "n")
    wanted = members.select("digest")
    if wanted.count() <= IDS_TO_BROADCAST // 4:  # digests are longer than numbers
        wanted = F.broadcast(wanted)
    texts = (
        lines.join(wanted, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.first("norm").alias("norm"))
    )
    members = scratch.write(members.join(texts, "digest"), "members")
    other = F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / TILE).cast("int") - 1))
    tiles = (
        members.withColumn("other", other)
        .withColumn("tile_row", F.least("block", "other"))
        .withColumn("tile_column", F.greatest("block", "other"))
        .select(*TILE_COLUMNS)
        .repartition("component", "tile_row", "tile_column")
        .sortWithinPartitions("component", "tile_row", "tile_column", "digest")
        .mapInArrow(_verify(most_different, similarity), "u binary, v binary")
    )
    joined = connected_components(tiles, scratch).withColumnRenamed("node", "digest")
    linked = candidates.drop("component").join(joined, "digest", "left")
    return linked.filter("component is not null or n > 1").select(
        "digest", F.coalesce("component", "digest").alias("group"), "id", "n"
    )


def fuzzy_line_dedup(
    docs: DataFrame,
    similarity: float = 0.8,
    most_different: int = 3,
    blocks: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per line that goes: `(doc_id, line, start, end, keep_id, keep_line,
    occurrences)`; offsets are characters of the text, without the line's end.

    More `blocks` make more, but more selective keys; the result is the same.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    text_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_col).alias("text"),
    )
    lines = scratch.write(rows.mapInArrow(_lines_of(), SCHEMA), "lines")
    groups = scratch.write(
        line_groups(lines, scratch, blocks, most_different, similarity), "groups"
    )
    totals = (
        groups.groupBy("group")
        .agg(F.min("id").alias("keep_id"), F.sum("n").alias("occurrences"))
        .filter("occurrences > 1")
    )
    repeated = scratch.write(
        groups.join(totals, "group").select("digest", "group", "n", "keep_id", "occurrences"),
        "repeated",
    )
    found = scratch.write(
        lookup(lines.select("id", "line", "start", "end", "digest"), repeated, "digest", "n"),
        "found",
    )
    kept = (
        found.filter("id = keep_id")
        .groupBy("group")
        .agg(F.min("line").alias("keep_line"), F.max("occurrences").alias("occurrences"))
    )
    nullable = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (
        lookup(found.drop("occurrences"), scratch.write(kept, "kept"), "group", "occurrences")
        .filter("id <> keep_id or line <> keep_line")
        .select(
            nullable("id").alias(id_col),
            "line",
            "start",
            "end",
            nullable("keep_id"),
            "keep_line",
            "occurrences",
        )
    )
