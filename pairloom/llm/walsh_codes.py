"""Vector code compression: product quantisation with exact integer Walsh-Hadamard search.

A vector's components become whole numbers, floor(1024 x), and the vector is cut into equal
consecutive parts, each with its own codebook. Every round gives each part its codebook's
nearest entry (ties to the lower index) and moves each entry to the floor of the mean of its
parts; unused entries stay.

The nearest entry is searched in whole numbers throughout. Parts and entries are padded with
zeros to a power of two P and put through the Walsh-Hadamard transform, which multiplies every
squared distance by P exactly. The squared differences of the coefficients are added in
sequency order, where the slowly changing patterns come first; the sum so far is a lower
bound, so an entry is out once it exceeds the whole distance to the entry that leads after
the first coefficients. What is left at the end is P times the true distance.

Spark deals the vectors; a task sends one row for each entry's component and round, whatever
its number of vectors. The codebooks are fixed in size by the parameters (entries x
components) and go to the tasks with the job.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped.
Vectors of other lengths are filled with zeros to the longest, and that to a multiple of the
parts; empty vectors are all zeros. Repeated rows are coded each. Entries start from the
smallest ids; rows of one id rank by their vectors, null ids come last, and fewer rows than
entries give fewer entries. Labels that are null belong together. Components of any size are
computed exactly, without a floating-point step; an error over the range of a long is null,
and so is its label's sum. Whole numbers of 2**62 and more raise ValueError. An empty table gives an empty
result. Texts do not occur; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, lookup

BLOCK = 1024
HEAD = 4
LARGEST_LONG = 2**63 - 1
LARGEST_COMPONENT = 2**62


def sequency_order(n: int) -> np.ndarray:
    """Rows of the n x n Hadamard matrix by their number of sign changes; n a power of two."""
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    order = np.zeros(n, np.int64)
    for bit in range(n.bit_length() - 1):
        order |= ((gray >> bit) & 1) << (n.bit_length() - 2 - bit)
    return order


def walsh(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, padded with zeros, in sequency order."""
    n = 1 << max(x.shape[1] - 1, 0).bit_length()
    y = np.zeros((len(x), n), x.dtype)
    y[:, : x.shape[1]] = x
    h = 1
    while h < n:
        pairs = y.reshape(len(x), n // (2 * h), 2, h)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
        y = y.reshape(len(x), n)
        h *= 2
    return y[:, sequency_order(n)]


def _search(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed part its nearest transformed entry and their scaled distance."""
    t, e = np.ascontiguousarray(parts.T), np.ascontiguousarray(entries.T)
    sums = np.zeros((parts.shape[0], entries.shape[0]), parts.dtype)
    head = min(HEAD, len(t))
    for k in range(head):
        difference = np.subtract.outer(t[k], e[k])
        sums += difference * difference
    leader = entries[np.argmin(sums, axis=1)]
    bound = ((parts - leader) ** 2).sum(axis=1)
    row, col = np.nonzero(sums <= bound[:, None])
    left = sums[row, col]
    for k in range(head, len(t)):
        difference = t[k][row] - e[k][col]
        left = left + difference * difference
        stays = left <= bound[row]
        row, col, left = row[stays], col[stays], left[stays]
    # The leader is never out, and rows and entries are still in rising order.
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    least = np.minimum.reduceat(left, first)
    hits = np.flatnonzero(left == least[row])
    hits = hits[np.append(True, row[hits][1:] != row[hits][:-1])]
    return col[hits], least


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`(index, squared distance)` of the nearest entry of each part, exactly."""
    n = 1 << max(parts.shape[1] - 1, 0).bit_length()
    most = max(int(abs(parts).max(initial=0)), int(abs(entries).max(initial=0)))
    bits = 2 * (n * most).bit_length() + 2
    dtype = np.int32 if bits <= 31 else np.int64 if bits <= 63 else object
    parts, entries = walsh(parts.astype(dtype)), walsh(entries.astype(dtype))
    found = [_search(parts[at : at + BLOCK], entries) for at in range(0, len(parts), BLOCK)]
    index = np.concatenate([i for i, _ in found])
    return index, np.concatenate([d for _, d in found]) // n


def whole_numbers(vectors, width: int, scale: int) -> np.ndarray:
    """floor(scale x) of an Arrow list column, one row of `width` components a vector."""
    import math

    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * scale)
    if np.abs(scaled).max(initial=0) < 2**52:
        flat = scaled.astype(np.int64)
    else:
        flat = np.array([math.floor(int(v) * scale if v == int(v) else v * scale) for v in flat.tolist()], object)
        if max(abs(v) for v in flat) >= LARGEST_COMPONENT:
            raise ValueError("vector components of 2**62 and more, scaled, are not supported")
    lengths = np.array(vectors.value_lengths())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    rows = np.zeros((len(lengths), width), flat.dtype)
    rows[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return rows


def _decimals(values: np.ndarray):
    import pyarrow as pa

    if values.dtype == object:
        return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))
    return pa.array(values).cast(pa.decimal128(38, 0))


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector and all its components are there and finite."""
    finite = F.forall(
        vec_col,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vectors.filter(F.col(vec_col).isNotNull() & finite)


def _totals(kept: DataFrame, books: list[np.ndarray], width: int, scale: int) -> DataFrame:
    """`(part, entry, position, total, n)`: sums of the parts that each entry is nearest to."""

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = whole_numbers(batch.column("vector"), width, scale)
            for p, part in enumerate(np.split(rows, len(books), axis=1)):
                entry, _ = nearest(part, books[p])
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                if np.abs(part).max(initial=0) > 2**30:
                    sums[p], part = sums[p].astype(object), part.astype(object)
                sums[p][used] += np.add.reduceat(part[order], first, axis=0)
                counts[p] += np.bincount(entry, minlength=len(books[p]))
        for p, total in enumerate(sums):
            entry, position = np.indices(total.shape).reshape(2, -1)
            used = counts[p][entry] > 0
            entry, position = entry[used], position[used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(entry), p, np.int32)),
                    pa.array(entry.astype(np.int32)),
                    pa.array(position.astype(np.int32)),
                    _decimals(total[entry, position]),
                    pa.array(counts[p][entry]),
                ],
                ["part", "entry", "position", "total", "n"],
            )

    schema = "part int, entry int, position int, total decimal(38,0), n long"
    rows = kept.select("vector").mapInArrow(assign, schema)
    return rows.groupBy("part", "entry", "position").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def codebooks(
    kept: DataFrame, width: int, parts: int, entries: int, rounds: int, scale: int
) -> list[np.ndarray]:
    """The codebook of each part, from `kept(id, vector)`, after all rounds."""
    import pyarrow as pa

    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).limit(entries).select("vector").collect()
    column = pa.array([r.vector for r in first], pa.list_(pa.float64()))
    books = np.split(whole_numbers(column, width, scale), parts, axis=1)
    for _ in range(rounds):
        books = [b.astype(object) for b in books]
        moved = [b.copy() for b in books]
        for r in _totals(kept, [_narrow(b) for b in books], width, scale).collect():
            moved[r.part][r.entry, r.position] = int(r.total) // r.n
        books = moved
    return [_narrow(b) for b in books]


def _narrow(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64)


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    numbers = (str(v) for book in books for v in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """`(id, code, error, label_error, codebooks_sha256)` of every usable vector.

    `code` holds two hex digits a part, `error` the squared distance to the entries chosen,
    and `label_error` its sum over the rows of the label.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has room for 1 to 256 entries")
    scratch = Scratch(vectors.sparkSession, "codes")
    label = F.col(label_col).cast("string")
    kept = scratch.write(
        usable(vectors, vec_col).select(
            F.col(id_col).alias("id"),
            F.when(label.isNull(), "").otherwise(F.concat(F.lit("="), label)).alias("label"),
            F.col(vec_col).alias("vector"),
        ),
        "kept",
    )
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(parts, -(-longest // parts) * parts)
    books = codebooks(kept, width, parts, entries, rounds, scale)
    sha = digest(books)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hexes = np.array([f"{i:02x}" for i in range(256)], object)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = whole_numbers(batch.column("vector"), width, scale)
            code, error = "", 0
            for part, book in zip(np.split(rows, parts, axis=1), books):
                entry, distance = nearest(part, book)
                wide = distance.astype(object if distance.dtype == object else np.int64)
                code, error = code + hexes[entry], error + wide
            if error.dtype == object:
                error = [e if e <= LARGEST_LONG else None for e in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code), pa.array(error, pa.int64())],
                ["id", "label", "code", "error"],
            )

    id_type = kept.schema["id"].dataType.simpleString()
    coded = scratch.write(
        kept.mapInArrow(encode, f"id {id_type}, label string, code string, error long"), "coded"
    )
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(
        F.when(F.count("error") == F.count(F.lit(1)), total).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    sums = scratch.write(
        sums.select("label", "n", F.expr("try_cast(total AS bigint)").alias("label_error")), "sums"
    )
    return lookup(coded, sums, "label", "n").select(
        "id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256")
    )
