"""Checking one JSON line against the record schema, with built-in functions only.

JSON is read as VARIANT, which keeps the difference between a string and a number and
between null and absent; `from_json` would turn both into strings or nulls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import strip_space
from pairloom.schema import (
    LIST_FIELDS,
    OPTIONAL_LISTS,
    RECORD_FIELDS,
    REQUIRED_LISTS,
    REQUIRED_TEXT,
    field_type,
)
from pairloom.taxonomy import AXIS_COLUMNS, TAG_AXIS, TAG_COLUMN, TAXONOMY, Taxonomy

# Fixed value: a line of this many bytes or more ends the reading of its file.
MAX_LINE_BYTES = 10 << 20

OK, BLANK, FAILED, OVERLONG = "ok", "blank", "failed", "overlong"
LIST_OF_STRINGS = ("ARRAY<STRING>", "ARRAY<VOID>")


def new_seal() -> str:
    """A word no line can contain, for telling a whole line from a line with leftovers."""
    return uuid.uuid4().hex


def sealed_json(line: Column, seal: str) -> Column:
    """Parse `[<line>,"<seal>"]`; NULL unless the text is valid JSON.

    The JSON parser stops after the first complete value and accepts any text after it.
    Inside the array such leftovers either break the parse or keep the seal from being
    the second and last element, which `is_whole` tests.
    """
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{seal}"]')))


def is_whole(doc: Column, seal: str) -> Column:
    second = F.try_variant_get(doc, "$[1]", "string")
    third = F.try_variant_get(doc, "$[2]", "variant")
    return F.coalesce((second == seal) & third.isNull(), F.lit(False))


def field_path(name: str) -> str:
    return f"$[0].{name}"


def kind_of(doc: Column, path: str) -> Column:
    """`STRING`, `VOID` (a JSON null), `ARRAY<STRING>` and so on; NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def parsed_lines(lines: DataFrame, seal: str) -> DataFrame:
    """Add `overlong`, `doc` (sealed VARIANT or NULL), `rec` (a struct with the typed
    value of every field) and `shape` (a letter per field, see `field_letter`)."""
    line = F.col("value")
    docs = lines.withColumn(
        "overlong", F.octet_length(line) >= MAX_LINE_BYTES
    ).withColumn(
        "doc",
        # JSON's own white space needs no stripping; the rest of Unicode's is rare, so
        # only a line that does not parse is stripped and tried again.
        F.when(
            ~F.col("overlong"),
            F.coalesce(sealed_json(line, seal), sealed_json(strip_space(line), seal)),
        ),
    )
    values = [
        F.try_variant_get("doc", field_path(f), field_type(f).simpleString()).alias(f)
        for f in RECORD_FIELDS
    ]
    shape = F.concat(*[field_letter(f, seal) for f in CHECK_ORDER])
    return docs.withColumn("rec", F.struct(*values)).withColumn("shape", shape)


# The fields in the order they are checked, and the letters they should have.
CHECK_ORDER = REQUIRED_TEXT + REQUIRED_LISTS + OPTIONAL_LISTS
GOOD_SHAPE = "^t{8}l{5}[l-]{2}$"
BAD_LETTER = "(?<=^.{0,7})[^t]|(?<=^.{8,12})[^l]|(?<=^.{13,14})[^l-]"


def field_letter(name: str, seal: str) -> Column:
    """`t` for a text, `l` for a list of texts, `-` for absent, `x` for anything else.

    One short text for all fields keeps the generated code of the checks small enough for
    the JVM to compile; a comparison per field and rule does not.
    """
    kind = kind_of(F.col("doc"), field_path(name))
    if name in REQUIRED_TEXT:
        good, letter = kind == "STRING", "t"
    else:
        # `array_contains` is NULL only when the value is not found and an element is
        # null; a null between strings does not show in the kind.
        no_null = F.array_contains(F.col("rec")[name], F.lit(seal)).isNotNull()
        good, letter = kind.isin(*LIST_OF_STRINGS) & no_null, "l"
    return F.when(kind.isNull(), "-").when(good, letter).otherwise("x")


def _holds_nul() -> Column:
    # In valid JSON a NUL can only be written as this escape; the text is searched for
    # the character itself only where the escape occurs.
    escaped = F.contains("value", F.lit("\\u0000"))
    text = F.concat_ws("", *[F.col("rec")[f] for f in RECORD_FIELDS])
    return F.when(escaped, F.contains(text, F.lit("\x00"))).otherwise(False)


def _shape_reason() -> Column:
    names = F.array(*[F.lit(f) for f in CHECK_ORDER])
    at = F.regexp_instr("shape", F.lit(BAD_LETTER))
    absent = F.substring(F.col("shape"), at, F.lit(1)) == "-"
    rule = F.when(absent, "missing:").otherwise("type:")
    # A line holding only `null` counts as an object without fields; an array, a number
    # and so on has no fields either but is no object.
    is_object = kind_of(F.col("doc"), "$[0]").rlike("^(OBJECT<|VOID$)")
    return F.when(F.col("shape").startswith("-") & ~is_object, "json").otherwise(
        F.concat(rule, F.element_at(names, at))
    )


def reject_reason(seal: str, taxonomy: Taxonomy = TAXONOMY) -> Column:
    """The first failing check of a parsed line, NULL when there is none.

    `json`, then `missing:`/`type:` per field in order, then `enum:`, then `nul`.
    """
    chain = F.when(~is_whole(F.col("doc"), seal), "json").when(
        ~F.col("shape").rlike(GOOD_SHAPE), _shape_reason()
    )
    for name in AXIS_COLUMNS:
        unknown = ~F.col("rec")[name].isin(*taxonomy[name])
        chain = chain.when(unknown, f"enum:{name}")
    known = list(taxonomy[TAG_AXIS])
    # The lambda also ends a generated stage here: parse and checks in one would be over
    # the 8,000 bytes of bytecode up to which the JVM compiles a method.
    unknown = F.exists(F.col("rec")[TAG_COLUMN], lambda tag: ~tag.isin(*known))
    return chain.when(unknown, f"enum:{TAG_COLUMN}").when(_holds_nul(), "nul")


def bad_element(doc: Column, reason: Column, taxonomy: Taxonomy = TAXONOMY) -> Column:
    """Position (from 0) of the list element a `type:` or `enum:` reason is about.

    Costly, and meant for rejects only.
    """
    known = list(taxonomy[TAG_AXIS])
    tags = F.try_variant_get(doc, field_path(TAG_COLUMN), "array<string>")
    chain = F.when(
        reason == f"enum:{TAG_COLUMN}",
        F.array_position(F.transform(tags, lambda t: t.isin(*known)), F.lit(False)),
    )
    for name in LIST_FIELDS:
        elements = F.try_variant_get(doc, field_path(name), "array<variant>")
        texts = F.transform(elements, lambda e: F.schema_of_variant(e) == "STRING")
        chain = chain.when(
            reason == f"type:{name}", F.array_position(texts, F.lit(False))
        )
    # array_position counts from 1, and is 0 for "none" and NULL for "not a list".
    return (F.nullif(chain, F.lit(0)) - 1).cast("int")


def reject_stage(reason: Column) -> Column:
    """The step of the load that refused the record."""
    kind = F.substring_index(reason, ":", 1)
    return (
        F.when(kind == "json", "json")
        .when(kind.isin("missing", "type"), "field")
        .when(kind == "enum", "enum")
        .otherwise("insert")
    )


def checked_lines(lines: DataFrame, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """Give every line a status, and every good line its typed record.

    Keeps the columns of `lines` except `value`, and adds `status`, `reason` and
    `reject_value` (the whole text) of a failed line, and `rec`, NULL unless `ok`.
    Write the result before filtering it, as the load does: the optimizer would move a
    filter below the parse and repeat the parse in it.
    """
    seal = new_seal()
    keep = [c for c in lines.columns if c != "value"]
    judged = parsed_lines(lines, seal).withColumn(
        "reason", F.when(~F.col("overlong"), reject_reason(seal, taxonomy))
    )
    blank = F.col("doc").isNull() & (strip_space(F.col("value")) == "")
    status = (
        F.when(F.col("overlong"), OVERLONG)
        .when(F.col("reason").isNull(), OK)
        .when(blank, BLANK)
        .otherwise(FAILED)
    )
    failed = F.col("status") == FAILED
    return judged.withColumn("status", status).select(
        *keep,
        "status",
        F.when(failed, F.col("reason")).alias("reason"),
        F.when(failed, F.col("value")).alias("reject_value"),
        F.when(F.col("status") == OK, F.col("rec")).alias("rec"),
    )


def reject_details(rejects: DataFrame, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """Add `stage` and `element` to rows that have `reason` and `value`."""
    doc = sealed_json(strip_space(F.col("value")), new_seal())
    return rejects.withColumn("stage", reject_stage(F.col("reason"))).withColumn(
        "element", bad_element(doc, F.col("reason"), taxonomy)
    )
