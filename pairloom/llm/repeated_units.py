"""Substring dedup by hashing lines, paragraphs and parts of lines.

Units are normalised (A-Z lower-cased, white space runs to one space) and hashed to 128 bits.
The digests are counted over all documents; a digest's earliest occurrence, by document id
and place, is kept, and every other one is repeated and goes. Removed units are given with
their offsets in the original text, as are the parts that stay.

`unit="line"` and `"paragraph"` (parts between blank lines) do just that. `"passage"` takes
whole lines and also passages that begin or end within a line: lines of over `CUT_FROM` words
are cut after every word whose hash is the least among its two neighbours on either side, so
boundaries follow from five words of text alone, whatever stands before. Repeated parts that
follow one another, over line ends as well, are a run; a run of at least `min_run_words` words
goes. Of a repeated passage some 9 words are lost to cut units at its ends, so 51 words in
running text are found but for about one in a thousand. Phrases inside lines that are
shorter than a run stay. What goes always has an earlier occurrence that stays.

Only `(id, place, offsets, digest)` is shuffled, never text, and once, straight from the
texts; what is written is what goes. Equal digests meet and are counted where they meet. A unit
that stands in a third of all documents does not go to one task. Units that are many in their
batch are spread over the tasks, and the batch adds a row or two that count them. Those meet
the digest's other units, and the counts are joined to the spread ones: by a bounded broadcast
for digests that have a large share of the rows, by a shuffle for others.

Which units are spread depends on the batches, so `docs` should give the same rows in the same
order when a task is run again, as tables do that are read from files.

Defined cases: null or empty texts have no units; blank units are none, and do not interrupt
a run. Within a document the first of several equal units is its occurrence. A null id comes
after all others. Rows that share an id are taken for one document: they do not remove one
another's units. Very long texts are read whole, in batches bounded by their bytes. A script
without spaces has one word a line and is compared by lines. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import (
    HOT_SHARE,
    Scratch,
    by_bytes,
    columns_of_row,
    text_batches,
    whole_row,
)

UNITS = ("line", "paragraph", "passage")
CUT_FROM = 8
# Two 32-bit numbers a column: what is shuffled for every unit should be narrow. `flags` are
# 1 for a part, 2 for a whole line, 4 for the first of its digest, 8 for the first whole one,
# 16 where the digest has more than one in HOT_SHARE of the batch's units, and more than one;
# 32 in the rows that count those: `span` units, whole or not, `id` the smallest of theirs.
SCHEMA = (
    "id long, text_hash long, span long, size long, unit_flags long, hash long, rest long"
)
UNPACKED = {
    "unit": "cast(shiftright(unit_flags, 6) as int)",
    "start": "shiftright(span, 32)",
    "end": "span & 4294967295L",
    "words_before": "shiftright(size, 32)",
    "words": "size & 4294967295L",
    "part": "unit_flags & 1 = 1",
    "whole": "unit_flags & 2 = 2",
    "first": "unit_flags & 4 = 4",
    "first_whole": "unit_flags & 8 = 8",
}
MARKED, COUNTS = "unit_flags & 16 = 16", "unit_flags & 32 = 32"
DIGEST = ["hash", "rest"]
RESULT = ("kind", "unit", "start", "end", "words", "keep_id", "occurrences")


def spans(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """Start and end of every line or paragraph, in characters; they may be blank."""
    breaks = re.compile(r"\n[^\S\n]*\n" if unit == "paragraph" else r"\n")
    start = 0
    for end in [*(m.start() for m in breaks.finditer(text)), len(text)]:
        yield start, end
        start = end


def cuts_after(words: list[bytes]) -> np.ndarray:
    """The numbers of the words after which a line is cut."""
    from zlib import crc32

    if len(words) <= CUT_FROM:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))
    at = h[2:-2]
    least = (at < h[:-4]) & (at < h[1:-3]) & (at <= h[3:-1]) & (at <= h[4:])
    return np.flatnonzero(least) + 2


def pieces(text: str, unit: str) -> Iterator[tuple[int, int, list[bytes], bool, bool]]:
    """`(start, end, words, part, whole)` of every unit that is not blank.

    `part` units follow one another and make up runs; `whole` ones are lines or paragraphs.
    A line without cuts is both.
    """
    word = re.compile(r"[^ \t\n\r\x0b\f]+")
    for start, end in spans(text, unit):
        words = text[start:end].encode().lower().split()
        if not words:
            continue
        cuts = cuts_after(words) if unit == "passage" else ()
        yield start, end, words, not len(cuts), True
        if len(cuts):
            ends = [m.end() for m in word.finditer(text, start, end)]
            at = 0
            for cut in [*(cuts + 1).tolist(), len(words)]:
                stop = ends[cut - 1] if cut < len(words) else end
                yield start, stop, words[at:cut], True, False
                start, at = stop, cut


def document_units(text: str, unit: str) -> list[tuple]:
    """The rows of `SCHEMA` for one text, without its id."""
    from struct import unpack

    import xxhash

    rows, seen, seen_whole, number, before = [], set(), set(), 0, 0
    text_hash = xxhash.xxh64_intdigest(text.encode()) >> 1
    for start, end, words, part, whole in pieces(text, unit):
        # A cut line must not be taken for a part that reads the same.
        joined = b" ".join(words) if part else b"\n" + b" ".join(words)
        digest = xxhash.xxh3_128_digest(joined)
        flags = part + 2 * whole + 4 * (digest not in seen)
        flags += 8 * (whole and digest not in seen_whole)
        rows.append(
            (text_hash, start << 32 | end, before << 32 | len(words), number << 6 | flags)
            + unpack("<2q", digest)
        )
        seen.add(digest)
        if whole:
            seen_whole.add(digest)
        if part:
            number, before = number + 1, before + len(words)
    return rows


def _counts_of(marked):
    """The rows that count the marked units of a batch, by digest and by whole or not."""
    import pyarrow as pa

    flags = pa.array(marked["unit_flags"].to_numpy() & 2 | 48)
    groups = marked.set_column(4, "unit_flags", flags).group_by([*DIGEST, "unit_flags"])
    groups = groups.aggregate([("id", "min"), ("id", "count", pa.compute.CountOptions(mode="all"))])
    none = pa.nulls(len(groups), pa.int64())
    own = {"id": "id_min", "span": "id_count"}
    columns = [
        none if n in ("text_hash", "size") else groups[own.get(n, n)] for n in marked.column_names
    ]
    return pa.table(columns, marked.column_names).combine_chunks().to_batches()


def _units_of(unit: str):
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = [pa.int64()] * 6

    def batches(parts: Iterator) -> Iterator:
        for _, part in by_bytes(parts, "text"):
            at, rows = [], []
            for k, text in enumerate(part.column("text")):
                found = document_units(text.as_py() or "", unit)
                rows += found
                at += [k] * len(found)
            columns = zip(*rows) if rows else [()] * len(types)
            arrays = dict(zip(names[1:], (pa.array(c, t) for c, t in zip(columns, types))))
            _, inverse, n = np.unique(
                arrays["hash"].to_numpy(), return_inverse=True, return_counts=True
            )
            often = ((n > 1) & (n * HOT_SHARE > len(rows)))[inverse]
            arrays["unit_flags"] = pa.array(arrays["unit_flags"].to_numpy() | 16 * often)
            ids = part.column("id").combine_chunks().take(pa.array(at, pa.int64()))
            found = pa.RecordBatch.from_arrays([ids, *arrays.values()], names)
            yield found
            if often.any():
                yield from _counts_of(pa.Table.from_batches([found.filter(pa.array(often))]))

    return batches


def hot_hashes(units: DataFrame) -> DataFrame:
    """`(hash)` of every digest that has more than two in HOT_SHARE of all rows, and of few
    others; there are fewer than HOT_SHARE.

    Only units marked as often in their batch are counted: what has two in HOT_SHARE of all
    rows has at least one of them in batches where it is marked.
    """
    total = units.count()
    marked = units.filter("unit_flags & 16 = 16").groupBy("hash").agg(F.count("*").alias("n"))
    return marked.filter(F.col("n") * HOT_SHARE > total).select("hash")


def with_counts(units: DataFrame, counted: DataFrame, facts: list[str]) -> DataFrame:
    """`units`, the marked ones with the facts of their digest from `counted`.

    The facts of hot digests are broadcast; the other digests' marked units are shuffled,
    and no task gets more than a HOT_SHARE-th of the rows for one.
    """
    counted = counted.select(*DIGEST, *[F.col(f).alias(f"all_{f}") for f in facts])
    hot = counted.join(F.broadcast(hot_hashes(units)), "hash", "left_semi")
    met = units.join(F.broadcast(hot), DIGEST, "left")
    late = F.expr(f"{MARKED} and all_occurrences is null")
    others = met.filter(late).select(units.columns).join(counted, DIGEST)
    met = met.filter(~late).unionByName(others)
    own = {f: F.when(F.expr(MARKED), F.col(f"all_{f}")).otherwise(F.col(f)) for f in facts}
    return met.withColumns(own).select(units.columns)


def repeated_units(
    docs: DataFrame,
    unit: str = "passage",
    min_run_words: int = 30,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per unit that goes: `(doc_id, text_hash, kind, unit, start, end, words, keep_id,
    occurrences)`. `kind` is `whole` for a line or paragraph, `part` for one in a run;
    `keep_id` is the document whose occurrence stays. A part may lie in a line that goes."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    scratch = Scratch(docs.sparkSession, "units")
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    units = rows.mapInArrow(_units_of(unit), SCHEMA)
    # Marked units stand among a few of their own; the rows that count them, among the others.
    alone = F.when(F.expr(f"{MARKED} and not {COUNTS}"), F.xxhash64("id", "text_hash", "span"))
    met = units.withColumn("spread", F.coalesce(F.pmod(alone, F.lit(HOT_SHARE)) + 1, F.lit(0)))
    digest = Window.partitionBy(*DIGEST, "spread")
    n = F.when(F.expr(COUNTS), F.col("span")).otherwise(1)
    is_whole = F.expr(UNPACKED["whole"])
    # The smallest id is that of the unit that stays; it is null only where all ids are.
    facts = {
        "keep": F.min("id"),
        "keep_whole": F.min(F.when(is_whole, F.col("id"))),
        "wholes": F.sum(F.when(is_whole, n).otherwise(0)),
    }
    met = met.withColumn("occurrences", F.sum(n).over(digest))
    met = met.filter(f"occurrences > 1 or {MARKED}").withColumns(
        {name: column.over(digest) for name, column in facts.items()}
    )
    facts = ["occurrences", *facts]

    def judged(rows: DataFrame) -> DataFrame:
        whole = "whole and wholes > 1 and not (id <=> keep_whole and first_whole)"
        part = "part and not (id <=> keep and first)" if unit == "passage" else "false"
        rows = rows.withColumns({name: F.expr(how) for name, how in UNPACKED.items()})
        rows = rows.withColumns({"is_whole": F.expr(whole), "is_part": F.expr(part)})
        return rows.withColumn("goes", F.expr("occurrences > 1 and (is_whole or is_part)"))

    met = judged(met).filter(f"goes or {MARKED}").select(*units.columns, *facts)
    met = scratch.write(met, "met")
    counted = met.filter(COUNTS).select(*DIGEST, *facts).distinct()
    counted = scratch.write(counted, "counted")
    found = judged(with_counts(met.filter(f"not {COUNTS}"), counted, facts)).filter("goes")

    def result(df: DataFrame, kind: str, keep: str, occurrences: str) -> DataFrame:
        own = {"kind": F.lit(kind), "keep_id": F.col(keep), "occurrences": F.col(occurrences)}
        columns = [own.get(name, F.col(name)).alias(name) for name in RESULT]
        return df.select(F.col("id").alias(id_col), "text_hash", *columns)

    wholes = result(found.filter("is_whole"), "whole", "keep_whole", "wholes")
    if unit != "passage":
        return wholes
    # A run is a stretch of following numbers; rows of equal documents share numbers.
    document = Window.partitionBy("id", "text_hash")
    place = F.col("unit") - F.dense_rank().over(document.orderBy("unit"))
    run = Window.partitionBy("id", "text_hash", "run")
    last = F.max(F.col("words_before") + F.col("words")).over(run)
    length = last - F.min("words_before").over(run)
    runs = found.filter("is_part").withColumn("run", place).withColumn("run_words", length)
    long_runs = runs.filter(F.col("run_words") >= min_run_words)
    return wholes.unionByName(result(long_runs, "part", "keep", "occurrences"))


def without_units(
    docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with what stays of each text, and `kept_spans`, where that stood before.

    `removed` is what `repeated_units` found in `docs`. The text's hash tells rows apart
    that share an id.
    """
    import xxhash

    text_batches(docs.sparkSession)
    spans_ = "array<struct<start:long,end:long>>"

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: xxhash.xxh64_intdigest((t or "").encode()) >> 1).astype("int64")

    @F.pandas_udf(spans_)
    def kept(texts: pd.Series, gone: pd.Series) -> pd.Series:
        def one(text, cuts):
            out, at = [], 0
            for cut in sorted((c["start"], c["end"]) for c in cuts):
                out.append({"start": at, "end": cut[0]})
                at = max(at, cut[1])
            out.append({"start": at, "end": len(text or "")})
            return [s for s in out if s["start"] < s["end"]]

        return pd.Series([one(t, g) for t, g in zip(texts, gone)])

    @F.pandas_udf("string")
    def joined(texts: pd.Series, stay: pd.Series) -> pd.Series:
        cut = lambda t, s: t and "".join(t[x["start"] : x["end"]] for x in s)
        return pd.Series([cut(t, s) for t, s in zip(texts, stay)])

    cuts = removed.groupBy(F.col(id_col).alias("cut_id"), "text_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("cuts")
    )
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(
        whole_row(docs).alias("row"), F.col(id_col).alias("id"), hashed(text_col).alias("hash")
    )
    same = (F.col("hash") == F.col("text_hash")) & F.col("id").eqNullSafe(F.col("cut_id"))
    none = F.array().cast(spans_)
    found = rows.join(cuts, same, "left").withColumn("stays", kept(text, F.coalesce("cuts", none)))
    found = found.withColumn("left", joined(text, "stays"))
    columns = [
        F.col("left").alias(text_col) if name == text_col else column
        for name, column in zip(docs.columns, columns_of_row(docs))
    ]
    return found.select(*columns, F.col("stays").alias("kept_spans"))
