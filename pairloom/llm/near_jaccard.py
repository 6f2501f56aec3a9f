"""Near-dedup by the exact Jaccard similarity of word shingles.

Each text becomes the set of its shingles of `shingle` words, as 64-bit hashes; equal sets
are one node from there on. `BANDS` keys of `ROWS` minima each bring two sets of similarity
s together in all but (1 - s^ROWS)^BANDS of cases: one in seven million at 0.8, fewer above.
Nodes that share a key are linked to the key's smallest node, never to one another, and the
components of these links are candidates. Only their sets are computed again and compared,
in tiles of `TILE` by `TILE` nodes, so a group of any size is shared by many tasks. Sets that
share a key are linked if their Jaccard similarity is at least `similarity`; pairs that are
connected already are not compared again, which cannot change a class.

Defined cases: words are runs of bytes other than white space, A-Z lower-cased. Fewer words
than a shingle count as one shingle; all texts without a word, and null, have the same empty
set. Rows that share an id stay if it is the smallest of any of their classes. A null id is
in its class but does not name it; rows without an id stay. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import IDS_TO_BROADCAST, Scratch, lookup, text_batches, without_ids
from pairloom.llm.components import connected_components

BANDS = 30
ROWS = 4
SEED = 42
TILE = 256
SHINGLES_AT_ONCE = 1 << 12


def _sets(shingle: int, whole: bool):
    """`(id, digest, size, keys)` of each text, with its set as bytes if `whole`."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    random = np.random.default_rng(SEED)
    odd = lambda n: random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    places, factors, mixers = odd(shingle), odd(BANDS * ROWS), odd(ROWS)
    shift, spread = np.uint64(32), np.uint64(0x9E3779B97F4A7C15)

    def hashes(text: str | None):
        words = (text or "").encode("utf-8").lower().split()
        found = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        if not len(found):
            return found
        width = min(shingle, len(found))
        count = len(found) - width + 1
        total = np.full(count, width, np.uint64)
        for k in range(width):
            total += found[k : k + count] * places[k]
        total = (total ^ (total >> shift)) * spread
        return np.unique(total ^ (total >> shift))

    def keys(found):
        least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(found), SHINGLES_AT_ONCE):
            part = found[at : at + SHINGLES_AT_ONCE]
            for k in range(BANDS * ROWS):
                # The product's low bits know only the low bits of the hash: turn them.
                turned = part * factors[k]
                least[k] = min(least[k], ((turned >> shift) * factors[-1 - k] ^ turned).min())
        bands = (least.reshape(BANDS, ROWS) * mixers).sum(axis=1, dtype=np.uint64)
        return bands ^ (np.arange(BANDS, dtype=np.uint64) * spread)

    def batches(parts: Iterator) -> Iterator:
        for part in parts:
            sets = [hashes(t.as_py()) for t in part.column("text")]
            columns = {
                "id": part.column("id"),
                "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                "size": pa.array([len(s) for s in sets], pa.int64()),
            }
            if whole:
                columns["hashes"] = pa.array([s.tobytes() for s in sets], pa.binary())
            else:
                made = [keys(s).view(np.int64) for s in sets]
                columns["keys"] = pa.array([k.tolist() for k in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return batches


def _verify(similarity: float):
    import numpy as np
    import pandas as pd

    def tile(nodes: pd.DataFrame) -> pd.DataFrame:
        """Links of one tile: nodes of the row block with those of the column block."""
        rows = nodes[nodes["block"] == nodes["tile_row"]].sort_values("digest")
        columns = nodes[nodes["block"] == nodes["tile_column"]].sort_values("digest")
        parent: dict[bytes, bytes] = {}

        def root(d: bytes) -> bytes:
            while parent.setdefault(d, d) != d:
                parent[d] = parent[parent[d]]
                d = parent[d]
            return d

        found = []
        names = rows["digest"].tolist(), columns["digest"].tolist()
        left, right = ([np.frombuffer(h, np.uint64) for h in x["hashes"]] for x in (rows, columns))
        keys = np.stack(columns["keys"].to_numpy())
        sizes = columns["size"].to_numpy()
        for i, own in enumerate(rows["keys"]):
            less, more = np.minimum(sizes, len(left[i])), np.maximum(sizes, len(left[i]))
            near = (keys == own).any(axis=1) & (less >= similarity * more - 1e-9)
            for j in np.flatnonzero(near).tolist():
                a, b = root(names[0][i]), root(names[1][j])
                if a == b:
                    continue
                both = len(np.intersect1d(left[i], right[j], assume_unique=True))
                if both >= similarity * (len(left[i]) + len(right[j]) - both) - 1e-9:
                    parent[max(a, b)] = min(a, b)
                    found.append((names[0][i], names[1][j]))
        return pd.DataFrame(found, columns=["u", "v"])

    return tile


def jaccard_classes(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: `(doc_id, component_id)`, the smallest id that is reached over
    sets that are at least so similar."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = scratch.write(
        rows.mapInArrow(
            _sets(shingle, False), "id long, digest binary, size long, keys array<long>"
        ),
        "sets",
    )
    nodes = scratch.write(
        sets.groupBy("digest").agg(
            F.min("id").alias("least"),
            F.count(F.lit(1)).alias("n"),
            F.max("size").alias("size"),
            F.max("keys").alias("keys"),
        ),
        "nodes",
    )
    keyed = nodes.select("digest", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("digest").alias("v"), F.count(F.lit(1)).alias("m"))
    shared = scratch.write(shared.filter("m > 1"), "shared")
    links = lookup(keyed, shared, "key", "m").select(F.col("digest").alias("u"), "v")
    near = scratch.write(connected_components(links, scratch), "near")
    sizes = near.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    sizes = scratch.write(sizes, "sizes")
    block = F.pmod(F.xxhash64("digest"), F.ceil(F.col("m") / TILE)).cast("int")
    members = lookup(near.withColumnRenamed("node", "digest"), sizes, "component", "m")
    members = members.withColumn("block", block).join(nodes, "digest")
    members = scratch.write(members.drop("n"), "candidates")
    # Texts are read again for candidates only; those without an id cannot be looked up.
    wanted = members.select(F.col("least").alias("id")).filter("id is not null").distinct()
    if wanted.count() <= IDS_TO_BROADCAST:
        wanted = F.broadcast(wanted)
    again = rows.join(wanted, "id", "left_semi").unionByName(rows.filter("id is null"))
    hashes = (
        again.mapInArrow(
            _sets(shingle, True), "id long, digest binary, size long, hashes binary"
        )
        .groupBy("digest")
        .agg(F.first("hashes").alias("hashes"))
    )
    members = scratch.write(members.join(hashes, "digest"), "members")
    other = F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / TILE).cast("int") - 1))
    tiles = (
        members.withColumn("other", other)
        .withColumn("tile_row", F.least("block", "other"))
        .withColumn("tile_column", F.greatest("block", "other"))
        .groupBy("component", "tile_row", "tile_column")
        .applyInPandas(_verify(similarity), "u binary, v binary")
    )
    joined = connected_components(tiles, scratch).withColumnRenamed("node", "digest")
    placed = nodes.select("digest", "least", "n").join(joined, "digest", "left")
    placed = placed.withColumn("component", F.coalesce("component", "digest"))
    placed = scratch.write(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select("digest", "n", "component_id")
    return lookup(sets.select("id", "digest"), named, "digest", "n").select(
        F.col("id").alias(id_col), "component_id"
    )


def without_similar(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` with one document of each class, that with the smallest id."""
    scratch = Scratch(docs.sparkSession, "similar")
    classes = jaccard_classes(docs, shingle, similarity, id_col, text_col)
    stays = F.max(F.col(id_col) == F.col("component_id"))
    dropped = (
        classes.groupBy(F.col(id_col).alias("id")).agg(stays.alias("stays")).filter("not stays")
    )
    return without_ids(docs, scratch.write(dropped.select("id"), "dropped"), id_col)
