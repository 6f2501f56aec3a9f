"""Columns and types of a record, of a stored row and of an exported row."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a record, in the order they are checked and exported.
REQUIRED_TEXT = (
    "task_id",
    "domain",
    "difficulty",
    "task_shape",
    "user_request",
    "context",
    "reasoning_summary",
    "final_answer",
)
REQUIRED_LISTS = (
    "capability_tags",
    "success_criteria",
    "plan",
    "self_check",
    "quality_notes",
)
OPTIONAL_LISTS = ("references", "artifacts")
RECORD_FIELDS = (
    "task_id",
    "domain",
    "difficulty",
    "task_shape",
    "capability_tags",
    "user_request",
    "context",
    "success_criteria",
    "plan",
    "reasoning_summary",
    "final_answer",
    "self_check",
    "quality_notes",
    "references",
    "artifacts",
)

LIST_FIELDS = REQUIRED_LISTS + OPTIONAL_LISTS
EXPORT_FIELDS = RECORD_FIELDS + ("created_at",)
NULLABLE_FIELDS = OPTIONAL_LISTS + ("created_at",)


def field_type(name: str) -> T.DataType:
    if name == "created_at":
        return T.TimestampType()
    if name in LIST_FIELDS:
        return T.ArrayType(T.StringType())
    return T.StringType()


RECORD_SCHEMA = T.StructType(
    [T.StructField(f, field_type(f), f in NULLABLE_FIELDS) for f in RECORD_FIELDS]
)
EXPORT_SCHEMA = T.StructType(
    [T.StructField(f, field_type(f), f in NULLABLE_FIELDS) for f in EXPORT_FIELDS]
)
STORE_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False), *EXPORT_SCHEMA.fields]
)
