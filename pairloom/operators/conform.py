"""The strict record schema, as a report of violations.

Loading is more lenient on purpose (empty texts, empty lists and unknown keys pass). This
report applies every rule of the published schema, to raw lines, and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.record import field_path, is_whole, kind_of, new_seal, sealed_json
from pairloom.functions.text import strip_space
from pairloom.schema import (
    OPTIONAL_LISTS,
    RECORD_FIELDS,
    REQUIRED_LISTS,
    REQUIRED_TEXT,
)
from pairloom.taxonomy import AXIS_COLUMNS, TAG_AXIS, TAG_COLUMN, TAXONOMY, Taxonomy


def strict_violations(lines: DataFrame, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """`(<columns of lines but value>, task_id, field, rule)`, one row per broken rule.

    `rule` is `json`, `required`, `type`, `enum`, `minLength`, `minItems`, `items.type`,
    `items.enum`, `items.minLength` or `additionalProperties`. `field` is empty for a rule
    about the record as a whole. Needs the session settings
    of `session.configure` for objects that give a key twice.
    """
    seal = new_seal()
    keep = [c for c in lines.columns if c != "value"]
    line = strip_space(F.col("value"))
    whole = (
        lines.where(line != "")
        .withColumn("doc", sealed_json(line, seal))
        .withColumn("whole", is_whole(F.col("doc"), seal))
    )
    doc = F.when(F.col("whole"), F.col("doc"))
    fields = whole.select(
        *keep,
        doc.alias("doc"),
        kind_of(doc, "$[0]").alias("root"),
        F.struct(*[kind_of(doc, field_path(f)).alias(f) for f in RECORD_FIELDS]).alias(
            "kind"
        ),
    )
    is_object = F.coalesce(F.col("root").startswith("OBJECT<"), F.lit(False))
    broken = F.array_compact(F.array(*_field_rules(taxonomy)))
    found = (
        F.when(is_object, F.concat(broken, _unknown_keys()))
        .when(F.col("root").isNull(), F.array(_violation(F.lit(""), "json")))
        .otherwise(F.array(_violation(F.lit(""), "type")))
    )
    return fields.select(
        *keep, _text("task_id").alias("task_id"), F.explode(found).alias("v")
    ).select(*keep, "task_id", "v.field", "v.rule")


def _violation(field: Column, rule: str) -> Column:
    return F.struct(field.alias("field"), F.lit(rule).alias("rule"))


def _text(name: str) -> Column:
    is_text = F.col("kind")[name] == "STRING"
    return F.when(is_text, F.try_variant_get("doc", field_path(name), "string"))


def _field_rules(taxonomy: Taxonomy) -> list[Column]:
    rules = []

    def rule(name: str, label: str, broken: Column) -> None:
        rules.append(F.when(broken, _violation(F.lit(name), label)))

    for name in RECORD_FIELDS:
        kind = F.col("kind")[name]
        if name not in OPTIONAL_LISTS:
            rule(name, "required", kind.isNull())
        if name in REQUIRED_TEXT:
            rule(name, "type", kind != "STRING")
            if name in AXIS_COLUMNS:
                known = F.coalesce(_text(name).isin(*taxonomy[name]), F.lit(False))
                rule(name, "enum", kind.isNotNull() & ~known)
            else:
                rule(name, "minLength", _text(name) == "")
            continue
        elements = F.try_variant_get("doc", field_path(name), "array<variant>")
        rule(name, "type", ~kind.startswith("ARRAY<"))
        if name in REQUIRED_LISTS:
            rule(name, "minItems", F.size(elements) == 0)
        rule(name, "items.type", F.exists(elements, lambda e: ~_is_text(e)))
        if name == TAG_COLUMN:
            known_tags = list(taxonomy[TAG_AXIS])
            unknown = F.exists(
                elements, lambda e: ~(_is_text(e) & _as_text(e).isin(*known_tags))
            )
            rule(name, "items.enum", unknown)
        else:
            empty = F.exists(elements, lambda e: _is_text(e) & (_as_text(e) == ""))
            rule(name, "items.minLength", empty)
    return rules


def _is_text(element: Column) -> Column:
    return F.schema_of_variant(element) == "STRING"


def _as_text(element: Column) -> Column:
    return F.try_variant_get(element, "$", "string")


def _unknown_keys() -> Column:
    keys = F.map_keys(F.try_variant_get("doc", "$[0]", "map<string,variant>"))
    known = F.array(*[F.lit(f) for f in RECORD_FIELDS])
    return F.transform(
        F.array_except(keys, known), lambda k: _violation(k, "additionalProperties")
    )


def has_timestamp_id(task_id: Column) -> Column:
    """Does the id end in `-YYYYMMDD-HHmmss`, with a date and time that exist?"""
    shaped = task_id.rlike(r"^.+-\d{8}-\d{6}$")
    moment = F.try_to_timestamp(F.right(task_id, F.lit(15)), F.lit("yyyyMMdd-HHmmss"))
    return F.coalesce(shaped & moment.isNotNull(), F.lit(False))
