"""Best-fit packing of documents into fixed-length sequences by linear grouping.

Documents are tokenised once; only the length and checksum of each piece go on, so no text
or token is ever shuffled. All planning is on the histogram of piece lengths, which has
at most `capacity` rows whatever the size of the corpus:

1. Pieces over `small_share` of the capacity are large. In order of falling length they are
   cut into `groups` of equal cardinality, and each is rounded up to its group's longest.
2. The few sizes left make a cutting-stock programme, which is solved by column generation:
   a configuration says how many of each size fill one sequence.
3. The actual pieces take the places of their group, and their true lengths give the gaps.
4. What rounding the programme down left over, and all small pieces, are best-fit from long
   to short into the tightest gap they fit, and into new sequences where none is left.

What counts as large decides how much rounding costs and how much best fit can mend, so the
plan is made for each of `small_shares` and the one with the fewest sequences is kept.

The plan is a list of runs "ranks lo to hi of length l go to sequences from s on, at offset
o", a few thousand for any corpus. Every piece gets its rank within its length from counts
of hashed buckets, so a length that a third of all pieces share is split as well, and finds
its place by binary search in the runs.

Defined cases: a null text is empty; an empty document is the end token alone. Documents
over the capacity are cut, and the first piece is the short one. Repeated rows are packed
as often as they occur. Null ids are packed too. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, text_batches

PIECES = "id long, piece int, start long, length long, ids_crc32 long"

SMALL_SHARES = (0.125, 0.25, 0.34, 0.4, 0.45, 0.5)

# Characters on which the two tokeniser libraries split words alike whatever version of
# Unicode they follow. Texts with others, or with a special token's string, take the
# library that reads the JSON file.
COMMON_TEXT = re.compile("[\t\n\r -~ -ɏ‐-‧€]*")
SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of a byte-level BPE; the faster library where both must agree."""

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None) -> None:
        self.json_path = json_path
        self.exact = self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as lines:
                pairs = (line.split() for line in lines)
                ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            self.fast = tiktoken.Encoding(
                "common", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def ids(self, text: str) -> np.ndarray:
        if self.fast and SPECIAL not in text and COMMON_TEXT.fullmatch(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return self.exact_ids(text)

    def exact_ids(self, text: str) -> np.ndarray:
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.json_path)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def token_pieces(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`(id, piece, start, length, ids_crc32)` of every document with its end token.

    `ranks_path` and `pattern` give the same vocabulary to a faster library.
    """

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokens = Encoder(json_path, ranks_path, pattern)
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column("text")):
                ids = np.append(tokens.ids(text.as_py() or ""), end_id).astype("<u4")
                start = 0
                for piece, end in enumerate([*range(len(ids), 0, -capacity)][::-1]):
                    rows.append((at, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start = end
            at, *columns = zip(*rows) if rows else [()] * 5
            arrays = [batch.column("id").take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32"])

    text_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    ).mapInArrow(cut, PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple]:
    """Cutting stock by column generation: `(counts per size, times)` of the best basis."""
    n = len(sizes)
    order = np.argsort(sizes)
    rising = np.array(sizes)[order]
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    times = np.array(demand) / np.diag(basis)
    for _ in range(40 * n + 100):
        prices = np.linalg.solve(basis.T, np.ones(n))
        worth = prices[order]
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for w in range(int(rising[0]), capacity + 1):
            k = np.searchsorted(rising, w, side="right")
            values = best[w - rising[:k]] + worth[:k]
            top = int(np.argmax(values))
            if values[top] > best[w - 1]:
                best[w], choice[w] = values[top], top
            else:
                best[w] = best[w - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, w = np.zeros(n), capacity
        while w > 0:
            if choice[w] < 0:
                w -= 1
                continue
            column[order[choice[w]]] += 1
            w -= int(rising[choice[w]])
        direction = np.linalg.solve(basis, column)
        ratios = np.where(direction > 1e-9, times / np.maximum(direction, 1e-9), np.inf)
        leaves = int(np.argmin(ratios))
        step = ratios[leaves]
        times = np.maximum(times - step * direction, 0)
        times[leaves] = step
        basis[:, leaves] = column
    return [(tuple(basis[:, j].astype(int)), float(times[j])) for j in range(n)]


class Plan:
    """Runs `(length, lo, hi, sequence, offset, per_sequence)`.

    Rank r of a length in lo..hi-1 goes to `sequence + (r - lo) // per_sequence`, at
    `offset + (r - lo) % per_sequence * length`.
    """

    def __init__(self, histogram: dict[int, int], capacity: int, groups: int, small_share: float):
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, number)
        left = {length: 0 for length in histogram}  # ranks given out so far, by length
        self._large(histogram, left, groups, small_share)
        for length in sorted(histogram, reverse=True):
            if left[length] < histogram[length]:
                self._best_fit(length, left[length], histogram[length])

    def _keep(self, gap: int, first: int, number: int) -> None:
        if gap and number:
            self.open.setdefault(gap, []).append((first, number))

    def _large(self, histogram, left, groups: int, small_share: float) -> None:
        lengths = sorted((n for n in histogram if n > small_share * self.capacity), reverse=True)
        total = sum(histogram[n] for n in lengths)
        if not total:
            return
        per_group = -(-total // groups)
        sizes: list[int] = []
        demand: list[int] = []
        queues: list[list[list[int]]] = []  # per size, [length, number] from long to short
        room = 0
        for length in lengths:
            count = histogram[length]
            while count:
                if not room:
                    room = per_group
                    if not sizes or sizes[-1] != length:
                        sizes.append(length)
                        demand.append(0)
                        queues.append([])
                taken = min(room, count)
                demand[-1] += taken
                queues[-1].append([length, taken])
                room, count = room - taken, count - taken
        for counts, times in configurations(sizes, demand, self.capacity):
            places = [g for g, n in enumerate(counts) for _ in range(n)]
            # A rounding error below 1 never takes more than a group has.
            held = [sum(n for _, n in queues[g]) // c for g, c in enumerate(counts) if c]
            number = min([int(times + 1e-6), *held])
            if not number:
                continue
            cuts, slots = {0, number}, []
            for g in places:
                slot, at = [], 0
                while at < number:
                    entry = queues[g][0]
                    taken = min(entry[1], number - at)
                    slot.append((at, entry[0], left[entry[0]]))
                    left[entry[0]] += taken
                    at += taken
                    entry[1] -= taken
                    if not entry[1]:
                        queues[g].pop(0)
                    cuts.add(at)
                slots.append(slot)
            edges = sorted(cuts)
            for lo, hi in zip(edges, edges[1:]):
                offset = 0
                for slot in slots:
                    at, length, rank = next(x for x in reversed(slot) if x[0] <= lo)
                    rank += lo - at
                    self.runs.append((length, rank, rank + hi - lo, self.sequences + lo, offset, 1))
                    offset += length
                self._keep(self.capacity - offset, self.sequences + lo, hi - lo)
            self.sequences += number

    def _place(self, length: int, lo: int, first: int, number: int, gap: int, each: int) -> None:
        self.runs.append((length, lo, lo + number * each, first, self.capacity - gap, each))
        self._keep(gap - each * length, first, number)

    def _best_fit(self, length: int, lo: int, hi: int) -> None:
        while lo < hi:
            gaps = sorted(self.open)
            at = bisect_left(gaps, length)
            if at == len(gaps):
                break
            gap = gaps[at]
            first, number = self.open[gap].pop()
            if not self.open[gap]:
                del self.open[gap]
            each = min(gap // length, max(1, (hi - lo) // number))
            used = min(number, (hi - lo) // each)
            self._place(length, lo, first, used, gap, each)
            self._keep(gap, first + used, number - used)
            lo += used * each
        each = self.capacity // length
        for per, number in ((each, (hi - lo) // each), ((hi - lo) % each, 1)):
            if per and number:
                self._place(length, lo, self.sequences, number, self.capacity, per)
                self.sequences += number
                lo += per * number


def ranked(pieces: DataFrame, bucket_rows: int) -> DataFrame:
    """`rank` from 0 within each length, over hashed buckets of about `bucket_rows`."""
    buckets = max(1, -(-pieces.count() // bucket_rows))
    spread = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets))
    )
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    return (
        spread.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("bucket", "base", "place")
    )


def pack(
    pieces: DataFrame,
    scratch: Scratch,
    capacity: int = 2048,
    groups: int = 32,
    small_shares: tuple[float, ...] = SMALL_SHARES,
    bucket_rows: int = 10_000,
) -> DataFrame:
    """`pieces` with `(sequence_id, offset)`, by the plan of the fewest sequences."""
    pieces = scratch.write(pieces, "pieces")
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r.length: r.n for r in counted}
    plans = [Plan(histogram, capacity, groups, share) for share in small_shares]
    plan = min(plans, key=lambda p: p.sequences)
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 6)
    columns = ["id", "piece", "start", "length", "ids_crc32"]

    def placed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        # Ranks stay under 2^50, lengths under 2^13.
        keys = (runs[:, 0] << 50) + runs[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = runs[np.searchsorted(keys, (length << 50) + rank, side="right") - 1]
            turn = rank - run[:, 1]
            sequence, offset = run[:, 3] + turn // run[:, 5], run[:, 4] + turn % run[:, 5] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    return ranked(pieces, bucket_rows).mapInArrow(
        placed, PIECES + ", sequence_id long, offset long"
    )
