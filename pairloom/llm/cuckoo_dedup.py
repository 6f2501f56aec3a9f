"""Exact dedup over an index of live digests that is filtered by cuckoo filters.

Digests are dealt into shards by their bytes. Each shard keeps a cuckoo filter (16-bit
fingerprints, four slots a bucket) and, as its bucketed content, the full SHA-256 digests
with their number of live rows and the row that stays. A digest that misses the filter is
new and goes in; a hit is verified against the content, so that an equal fingerprint never
joins different texts. A deletion that takes the last live row takes the fingerprint out.
A filter that overflows is rebuilt with twice the buckets from the stored digests.

Texts are hashed where they are read and are never shuffled. Arrivals are counted per
digest before they go to their shard, at most `ARRIVALS` rows for a digest, so a text that
fills a third of all rows is a few rows; a shard holds about `shard_rows` digests and is
the unit of work, of memory and of recovery.

Defined cases: a null text equals the empty text. Rows with one id and one text count
separately and are all kept or all dropped. A null id is counted, and stays only where all
ids of the text are null. An empty table gives an empty result. Other columns are ignored.
Deleting a row that is not live, or one with a null id, changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, columns_of_row, lookup, whole_row, without_ids

ARRIVALS = 32
SLOTS = 4
KICKS = 200
STATE = "shard int, digest binary, n long, keep long, stale boolean, slots binary"


NO_ID = -(1 << 63)
"""Stands for "no id" inside a shard, where null would turn whole numbers into floats."""


def _largest(id_col: str) -> Column:
    return F.coalesce(F.max(id_col), F.lit(NO_ID))


class CuckooFilter:
    """Approximate set of digests with deletion; `insert` is False when it overflows."""

    def __init__(self, buckets: int, slots: bytes | None = None) -> None:
        import array

        self.mask = buckets - 1
        self.slots = array.array("H", slots or bytes(2 * SLOTS * buckets))

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return bucket ^ (print_ * 0x5BD1E995 >> 3 & self.mask)

    def _slot(self, bucket: int, print_: int) -> int:
        for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.slots[i] == print_:
                return i
        return -1

    def __contains__(self, digest: bytes) -> bool:
        print_, first, second = self._places(digest)
        return self._slot(first, print_) >= 0 or self._slot(second, print_) >= 0

    def insert(self, digest: bytes) -> bool:
        print_, first, second = self._places(digest)
        for bucket in (first, second):
            if (free := self._slot(bucket, 0)) >= 0:
                self.slots[free] = print_
                return True
        bucket = second
        for kick in range(KICKS):
            i = bucket * SLOTS + (kick * 7 + print_) % SLOTS
            print_, self.slots[i] = self.slots[i], print_
            bucket = self._other(bucket, print_)
            if (free := self._slot(bucket, 0)) >= 0:
                self.slots[free] = print_
                return True
        return False

    def remove(self, digest: bytes) -> None:
        print_, first, second = self._places(digest)
        for bucket in (first, second):
            if (i := self._slot(bucket, print_)) >= 0:
                self.slots[i] = 0
                return


def filled(buckets: int, digests) -> CuckooFilter:
    """A filter of all digests, doubled until they fit."""
    while True:
        found = CuckooFilter(buckets)
        if all(found.insert(d) for d in digests):
            return found
        buckets *= 2


class Shard:
    """Filter and content of one shard; arrivals are applied one after another."""

    def __init__(self, rows: list[tuple], first_buckets: int) -> None:
        self.content = {d: [n, keep, False] for d, n, keep, _, s in rows if d is not None}
        slots = next((s for d, _, _, _, s in rows if d is None), None)
        if slots is None:
            self.filter = CuckooFilter(first_buckets)
        else:
            self.filter = CuckooFilter(len(slots) // (2 * SLOTS), slots)

    def apply(self, digest: bytes, n: int, keep: int) -> None:
        # The filter is asked first; only a hit looks at the content.
        live = self.content.get(digest) if digest in self.filter else None
        if n > 0 and live is None:
            self.content[digest] = [n, keep, False]
            if not self.filter.insert(digest):
                self.filter = filled(2 * (self.filter.mask + 1), self.content)
        elif n > 0:
            live[0] += n
            live[1] = max(live[1], keep)
        elif live is not None:
            live[0] += n
            if live[0] <= 0:
                del self.content[digest]
                self.filter.remove(digest)
            elif keep == live[1]:
                live[2] = True

    def rows(self) -> Iterator[tuple]:
        for digest, (n, keep, stale) in self.content.items():
            yield digest, n, keep, stale, None
        yield None, 0, NO_ID, False, self.filter.slots.tobytes()


def _apply_to_shard(first_buckets: int):
    import pandas as pd

    columns = ["digest", "n", "keep", "stale", "slots"]

    def apply(key, state: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(list(state[columns].itertuples(index=False, name=None)), first_buckets)
        for digest, n, keep in zip(arrivals.digest, arrivals.n, arrivals.keep):
            shard.apply(digest, int(n), int(keep))
        out = pd.DataFrame(list(shard.rows()), columns=columns)
        out.insert(0, "shard", key[0])
        return out

    return apply


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(id, digest)` with the SHA-256 of the whole text in UTF-8."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest")
    )


class CuckooIndex:
    """The index as tables under `folder`: one generation of shards per batch, and the
    live members `(id, digest)` that a deletion needs to find the next row that stays.

    `shards` and `first_buckets` are fixed when the index is made.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int, first_buckets: int = 64):
        self.spark, self.folder, self.shards = spark, folder, shards
        self.first_buckets = first_buckets
        self.generation = 0
        self.state = spark.createDataFrame([], STATE)
        self.members = spark.createDataFrame([], "id long, digest binary")

    def _next(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{self.generation}"
        df.write.option("compression", "lz4").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _apply(self, keyed: DataFrame, sign: int) -> DataFrame:
        arrivals = (
            keyed.groupBy("digest", (F.spark_partition_id() % ARRIVALS).alias("part"))
            .agg((F.count(F.lit(1)) * sign).alias("n"), _largest("id").alias("keep"))
            .withColumn("shard", F.pmod(F.hash("digest"), F.lit(self.shards)))
            .select("shard", "digest", "n", "keep")
        )
        return (
            self.state.groupBy("shard")
            .cogroup(arrivals.groupBy("shard"))
            .applyInPandas(_apply_to_shard(self.first_buckets), STATE)
        )

    def insert(self, keyed: DataFrame) -> None:
        """Add rows `(id, digest)`."""
        self.generation += 1
        self.state = self._next(self._apply(keyed, 1), "state")
        self.members = keyed if self.generation == 1 else self._next(
            self.members.unionByName(keyed), "members"
        )

    def delete(self, keyed: DataFrame) -> None:
        """Take out rows `(id, digest)`; of a row that is there several times, all."""
        self.generation += 1
        gone = self.members.join(keyed.distinct(), ["id", "digest"], "left_semi")
        state = self._next(self._apply(gone, -1), "touched")
        self.members = self._next(
            self.members.join(keyed.distinct(), ["id", "digest"], "left_anti"), "members"
        )
        again = (
            self.members.join(state.filter("stale").select("digest"), "digest", "left_semi")
            .groupBy("digest")
            .agg(_largest("id").alias("next"))
        )
        fresh = state.join(again, "digest", "left").select(
            "shard",
            "digest",
            "n",
            F.when(F.col("stale"), F.col("next")).otherwise(F.col("keep")).alias("keep"),
            F.lit(False).alias("stale"),
            "slots",
        )
        self.state = self._next(fresh, "state")

    def classes(self) -> DataFrame:
        """`(digest, n, keep)` of every live digest."""
        keep = F.when(F.col("keep") != NO_ID, F.col("keep"))
        return self.state.filter("digest is not null").select("digest", "n", keep.alias("keep"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = 50_000
) -> DataFrame:
    """One row per document: `(doc_id, keep_id, group_size, kept, text_sha256)`.

    Of equal texts the row with the largest id stays.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    keyed = scratch.write(digests(docs, id_col, text_col), "digests")
    index = CuckooIndex(spark, scratch.path("index"), max(1, -(-keyed.count() // shard_rows)))
    index.insert(keyed)
    return lookup(keyed, index.classes(), "digest", "n").select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each text, that with the largest id.

    Where ids are null or repeated they do not name the rows, and rows that stay are told
    apart by their text's digest.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    rows = scratch.write(exact_dedup(docs, id_col, text_col), "rows")
    n_rows, n_ids = rows.agg(F.count(F.lit(1)), F.count_distinct(id_col)).first()
    if n_rows == n_ids:
        return without_ids(docs, rows.filter("not kept").select(F.col(id_col).alias("id")), id_col)
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    stays = rows.filter("kept").select(
        F.col(id_col).alias("kept_id"), F.col("text_sha256").alias("kept_digest")
    )
    hashed = docs.select(
        whole_row(docs).alias("row"), F.col(id_col).alias("id"), digest.alias("digest")
    )
    same = (F.col("digest") == F.col("kept_digest")) & F.col("id").eqNullSafe(F.col("kept_id"))
    one = hashed.join(stays, same, "left_semi").dropDuplicates(["digest"])
    return one.select(*columns_of_row(docs))
