"""Test inputs derived from the `documents` table, shared by the registered queries, the
benchmark and the tests. Not part of the library."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.schema import RECORD_FIELDS
from pairloom.taxonomy import axis_values

FILE_BYTES = 128 * 2**20
"""About the most bytes of lines that one task writes as a file."""


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder the cluster names; in the local temporary
    folder only where it names none and all work is done on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root}/pairloom-{name}-{uuid.uuid4().hex}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a valid stored pair, with `id` = `doc_id` + 1."""
    doc_id = F.col("doc_id")
    number = doc_id.cast("string")
    capabilities = axis_values("capability")
    tag_1 = _pick(capabilities, doc_id % 8 + 1)
    tag_2 = _pick(capabilities, (doc_id + 3) % 8 + 1)
    empty = F.array().cast("array<string>")
    fields = {
        "task_id": F.concat(F.lit("task-"), F.lpad(number, 12, "0")),
        "domain": _pick(axis_values("domain"), doc_id % 13 + 1),
        "difficulty": F.when(F.col("n_chars") < 500, "easy")
        .when(F.col("n_chars") < 2500, "medium")
        .otherwise("hard"),
        "task_shape": _pick(axis_values("task_shape"), F.expr("doc_id div 13") % 6 + 1),
        "capability_tags": F.when(doc_id % 3 == 0, F.array(tag_1))
        .when(doc_id % 3 == 1, F.array(tag_1, tag_2))
        .otherwise(F.array(tag_1, tag_1)),
        "user_request": F.concat(F.lit("Summarise document "), number),
        "context": F.col("source"),
        "success_criteria": F.array(F.concat(F.lit("lang is "), F.col("lang"))),
        "plan": F.array(F.lit("read"), F.lit("write")),
        "reasoning_summary": F.concat(F.lit("language "), F.col("lang")),
        "final_answer": F.col("text"),
        "self_check": F.array(F.lit("checked")),
        "quality_notes": F.array(
            F.concat(F.lit("n_chars "), F.col("n_chars").cast("string"))
        ),
        "references": F.when(
            doc_id % 2 != 0, F.array(F.concat(F.lit("doc:"), number))
        ),
        "artifacts": F.when(doc_id % 5 != 0, empty),
        "created_at": F.timestamp_micros(
            F.lit(1_735_689_600_000_000) + doc_id * 1_000_000
        ),
    }
    return documents(spark, sf_dir).select(
        (doc_id + 1).alias("id"), *[c.alias(name) for name, c in fields.items()]
    )


def _as_json() -> Column:
    """The record fields as one JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*RECORD_FIELDS))


def valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("id", _as_json().alias("value"))


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per document, `(id, value)`, damaged in one of 20 ways by `doc_id % 20`."""
    k = (F.col("id") - 1) % 20
    no_tags = F.array().cast("array<string>")
    strange_tags = F.array(F.lit("reasoning"), F.lit("telepathy"))
    fields = {
        "references": F.when(k != 6, F.col("references")),
        "domain": F.when(k == 7, "other").otherwise(F.col("domain")),
        "capability_tags": F.when(k == 8, strange_tags)
        .when(k == 9, no_tags)
        .otherwise(F.col("capability_tags")),
        "user_request": F.when(k == 10, "").otherwise(F.col("user_request")),
        "task_id": F.when(k == 12, "task-000000000000").otherwise(F.col("task_id")),
        "final_answer": F.when(
            k == 17, F.concat(F.lit("a\x00b"), F.col("final_answer"))
        ).otherwise(F.col("final_answer")),
    }
    rows = pairs(spark, sf_dir).withColumns(fields).withColumn("j", _as_json())
    # A quote inside a JSON string is escaped, so these patterns match the fields only.
    line = (
        F.when(k == 1, "{not valid json")
        .when(k == 2, F.expr("j || ' junk'"))
        .when(k == 3, F.expr("""replace(j, '"plan":["read","write"],', '')"""))
        .when(k == 4, F.expr("""replace(j, '"context":"' || context || '"', '"context":5')"""))
        .when(k == 5, F.expr("""replace(j, '["read","write"]', '["a",1]')"""))
        .when(k == 6, F.expr("""'{"references":null,' || substring(j, 2)"""))
        .when(
            k == 11,
            F.expr("""'{"extra":1,"created_at":"2020-01-01",' || substring(j, 2)"""),
        )
        .when(k == 13, F.concat(F.lit("   \n\n"), F.col("j")))
        .when(k == 14, "null")
        .when(k == 15, "[1]")
        .when(k == 16, F.expr("""'{"task_id":"first",' || substring(j, 2)"""))
        .when(k == 18, F.expr("""replace(j, '"self_check":["checked"]', '"self_check":"x"')"""))
        .when(k == 19, F.concat(F.lit("\u3000\t"), F.col("j"), F.lit("\r")))
        .otherwise(F.col("j"))
    )
    return rows.select("id", line.alias("value"))


def files_for(lines: DataFrame) -> int:
    """How many files of FILE_BYTES the lines fill."""
    held = lines.agg(F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0))).first()[0]
    return max(1, -(-held // FILE_BYTES))


def write_lines(lines: DataFrame, folder: str) -> str:
    """Write `(id, value)` as text files whose name order is the id order."""
    lines.repartitionByRange("id").sortWithinPartitions("id").select("value").write.text(
        folder
    )
    return folder
