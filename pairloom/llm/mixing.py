"""Temperature mixing of sources to target weights.

A source's weight is its share of all tokens to the power of an exponent, normalised:
1 keeps the natural mix, 0 makes all sources equal. The exponent is bisected until the mix
meets a target: an entropy that it must not exceed, or a limit on how often any source is
repeated, of which the flattest mix within the limit is taken.

The weights are realised within a token budget. Documents are hashed into blocks of about
`block_tokens` within their source. A source is read in passes, each in another permutation
of its blocks, until its quota is met; the block that crosses the quota is taken if at
least half of it lies within. Each draw has a `position`, the part of the source's quota that
comes before it: ordered by it, all sources run out together. Without a `budget` it is
the least at which every document is drawn at least once.

Only DataFrame functions are used. Text is read once for its length. Sources are a table and
are never collected; one row of sums for each tried exponent is. A pass's running sums are
taken over `BINS` slices of the permutation first and within each slice then, so even the
blocks of a source that holds a third of all rows are never in one task.

Defined cases: a null source is a source of its own, an empty or null text one token. Repeated
rows are drawn as often as they occur; null ids are drawn like others. With one source
its weight is 1. A limit under budget / tokens cannot be met; the budget is then cut to it.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, columns_of_row, lookup, whole_row

BINS = 256
BYTES_PER_TOKEN = 4
TRIED_AT_ONCE = 64
ROUNDS = 9
MOST_EXPONENT = 64.0


@dataclass(frozen=True)
class Target:
    """`kind` is "repetition" (most passes over any source) or "entropy" (in nats)."""

    kind: str
    value: float

    def __post_init__(self) -> None:
        if self.kind not in ("repetition", "entropy") or self.value < 0:
            raise ValueError(f"no such target: {self}")


def hashed(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts' text, as a whole number."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def tokens_of(text: Column) -> Column:
    size = F.coalesce(F.octet_length(text), F.lit(0))
    return F.greatest(F.lit(1), F.ceil(size / BYTES_PER_TOKEN)).cast("long")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def exponent(sources: DataFrame, target: Target, budget: float | None) -> float:
    """The least exponent that meets the target; `sources` has `tokens`."""
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))
    low, high = 0.0, 1.0 if target.kind == "repetition" else MOST_EXPONENT
    shares = sources.select(share.alias("p"))
    for _ in range(ROUNDS):
        step = (high - low) / (TRIED_AT_ONCE + 1)
        tried = F.array(*[F.lit(low + step * k) for k in range(TRIED_AT_ONCE + 1)])
        a, p = F.col("a"), F.col("p")
        sums = (
            shares.select("p", F.posexplode(tried).alias("k", "a"))
            .groupBy("k", "a")
            .agg(
                F.sum(F.pow(p, a)).alias("z"),
                F.sum(F.pow(p, a) * F.log(p)).alias("logs"),
                F.max(F.pow(p, a - 1)).alias("most"),
                F.min(F.pow(p, a - 1)).alias("least"),
            )
        )
        if target.kind == "entropy":
            meets = F.log("z") - a * F.col("logs") / F.col("z") <= target.value
        elif budget is None:
            meets = F.col("most") / F.col("least") <= target.value
        else:
            meets = budget / total / F.col("z") * F.col("most") <= target.value
        first = sums.filter(meets).agg(F.min("k")).first()[0]
        if first == 0:
            return low
        if first is None:
            low = low + step * TRIED_AT_ONCE
        else:
            low, high = low + step * (first - 1), low + step * first
    return high


def weighted(sources: DataFrame, alpha: float, target: Target, budget: float | None) -> DataFrame:
    """`sources` with `quota`, the tokens to draw from each."""
    total, z = sources.agg(F.sum("tokens"), F.sum(F.pow("tokens", F.lit(alpha)))).first()
    if total is None:
        return sources.withColumns({"weight": F.lit(0.0), "quota": F.lit(0.0)})
    weight = F.pow("tokens", F.lit(alpha)) / F.lit(z)
    if budget is None:
        budget = sources.agg(F.max(F.col("tokens") / weight)).first()[0]
    elif target.kind == "repetition":
        budget = min(budget, target.value * total)
    return sources.withColumns({"weight": weight, "quota": weight * F.lit(float(budget))})


@dataclass(frozen=True)
class Mix:
    """What to draw from a table of documents, and how to read it."""

    target: Target
    budget: float | None = None
    block_tokens: int = 20_000
    seed: int = 1
    id_col: str = "doc_id"
    text_col: str = "text"
    source_col: str = "source"


def _planned(docs: DataFrame, mix: Mix, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents as narrow rows with their block, and the sources with quotas."""
    rows = scratch.write(
        docs.select(
            F.col(mix.id_col).alias("id"),
            source_key(F.col(mix.source_col)).alias("source_key"),
            tokens_of(F.col(mix.text_col)).alias("tokens"),
        ),
        "rows",
    )
    sources = scratch.write(
        rows.groupBy("source_key").agg(
            F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
        ),
        "sources",
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tokens") / mix.block_tokens)).cast("long")
    alpha = exponent(sources, mix.target, mix.budget)
    sources = weighted(sources, alpha, mix.target, mix.budget).withColumn("blocks", blocks)
    sources = scratch.write(sources, "quotas")
    placed = lookup(rows, sources.select("source_key", "docs", "blocks"), "source_key", "docs")
    block = F.pmod(hashed(F.col("id"), F.lit(mix.seed)), F.col("blocks"))
    placed = placed.select("id", "source_key", "tokens", block.alias("block"))
    return scratch.write(placed, "placed"), sources


def _drawn(rows: DataFrame, sources: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """`(source_key, block, pass, order, start, quota)` of every block drawn."""
    blocks = rows.groupBy("source_key", "block").agg(F.sum("tokens").alias("block_tokens"))
    per_source = blocks.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
    quotas = sources.join(per_source, "source_key").select(
        "source_key", "n", "quota", F.col("tokens").alias("source_tokens")
    )
    last = F.ceil(F.col("quota") / F.col("source_tokens")).cast("int") - 1
    order = hashed(F.col("source_key"), F.col("pass"), F.col("block"), F.lit(seed))
    turns = (
        lookup(blocks, quotas, "source_key", "n")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
        .withColumn("order", order)
        .withColumn("bin", F.shiftright("order", 52))
    )
    turns = scratch.write(turns, "turns")
    bins = turns.groupBy("source_key", "pass", "bin").agg(F.sum("block_tokens").alias("in_bin"))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    by_bin = until(Window.partitionBy("source_key", "pass").orderBy("bin"))
    by_block = until(Window.partitionBy("source_key", "pass", "bin").orderBy("order", "block"))
    bins = bins.withColumn("before_bin", F.coalesce(F.sum("in_bin").over(by_bin), F.lit(0)))
    start = F.col("pass") * F.col("source_tokens") + F.col("before_bin") + F.col("before")
    return (
        turns.withColumn("before", F.coalesce(F.sum("block_tokens").over(by_block), F.lit(0)))
        .join(bins, ["source_key", "pass", "bin"])
        .withColumn("start", start)
        .filter(F.col("start") + F.col("block_tokens") / 2 <= F.col("quota"))
        .select("source_key", "block", "pass", "order", "start", "quota")
    )


def draws(docs: DataFrame, mix: Mix) -> DataFrame:
    """One row per draw: `(doc_id, source_key, pass, block, tokens, position)`.

    `position` is the part of the source's quota before the block, in millionths.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, sources = _planned(docs, mix, scratch)
    position = F.floor(F.col("start") / F.col("quota") * 1_000_000 + 0.5)
    drawn = _drawn(rows, sources, mix.seed, scratch).select(
        "source_key", "block", "pass", position.alias("position")
    )
    return rows.join(drawn, ["source_key", "block"]).select(
        F.col("id").alias(mix.id_col), "source_key", "pass", "block", "tokens", "position"
    )


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """`docs` with every row as often as it is drawn, in its own columns.

    The draws of a source come down to its full passes and, for the last pass, the place in
    the permutation where it ends. Both go to the rows with the source, so the text of
    a source with a thousandth of all rows or more is not shuffled.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, sources = _planned(docs, mix, scratch)
    ends = (
        _drawn(rows, sources, mix.seed, scratch)
        .groupBy("source_key")
        .agg(F.max(F.struct("pass", "order", "block")).alias("end"))
        .join(sources, "source_key")
        .select(
            "source_key", F.struct("end", "blocks").alias("plan"), F.col("docs").alias("n")
        )
    )
    ends = scratch.write(ends, "ends")
    end, pass_ = F.col("plan.end"), F.col("plan.end.pass")
    block = F.pmod(hashed(F.col("id"), F.lit(mix.seed)), F.col("plan.blocks"))
    place = F.struct(
        pass_.alias("pass"),
        hashed(F.col("source_key"), pass_, block, F.lit(mix.seed)).alias("order"),
        block.alias("block"),
    )
    times = pass_ + F.when(place <= end, 1).otherwise(0)
    # The caller's columns travel as one, so none of theirs meets one of these.
    keyed = docs.select(
        whole_row(docs).alias("row"),
        F.col(mix.id_col).alias("id"),
        source_key(F.col(mix.source_col)).alias("source_key"),
    )
    drawn = lookup(keyed, ends, "source_key", "n").withColumn("times", times)
    turns = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("turn")
    drawn = drawn.filter("times > 0").select("row", turns)
    return drawn.select(*columns_of_row(docs))
