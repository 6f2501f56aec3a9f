"""Coverage: the store -> one JSON document."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from pairloom.operators.coverage import MAP_FIELDS, coverage_document, document_of
from pairloom.plans.running_coverage import running_coverage
from pairloom.schema import STORE_SCHEMA
from pairloom.sources.folders import make_folder, write_text
from pairloom.sources.pair_store import PairStore, table_exists

# Fixed value: where the report goes when no path is given.
DEFAULT_OUTPUT = "/workspace/output/coverage.json"


def store_coverage(store: PairStore) -> DataFrame:
    """The coverage document of a store; an empty one when there is no store yet."""
    if store.exists():
        return coverage_document(store.read())
    return coverage_document(store.spark.createDataFrame([], STORE_SCHEMA))


def table_coverage(spark: SparkSession, name: str) -> DataFrame:
    """The coverage document of a catalog table of pairs; an empty one without the table."""
    if table_exists(spark, name):
        return coverage_document(spark.table(name))
    return coverage_document(spark.createDataFrame([], STORE_SCHEMA))


def document_text(document: DataFrame) -> str:
    """The one-row document as JSON: two-space indent, keys of the maps in byte order."""
    row = document.first()
    content = {"total_count": row.total_count}
    for name in MAP_FIELDS:
        content[name] = dict(sorted(row[name].items()))
    content["generated_at"] = row.generated_at
    text = json.dumps(content, indent=2, ensure_ascii=False)
    # Inside strings only; none of these occurs elsewhere in JSON.
    for char in ("<", ">", "&", "\u2028", "\u2029"):
        text = text.replace(char, f"\\u{ord(char):04x}")
    return text


def write_coverage(
    spark: SparkSession,
    store: PairStore,
    output: str = DEFAULT_OUTPUT,
    running: bool = False,
) -> str:
    """Write the coverage document of a store to one file, replacing it; returns the text.

    With `running`, batches counted by an earlier report are not read again, see
    `plans.running_coverage`; that writes beside the store.
    """
    if running and store.exists():
        text = document_text(document_of(running_coverage(store)))
    else:
        text = document_text(store_coverage(store))
    folder = output.rpartition("/")[0]
    if folder:
        make_folder(spark, folder)
    write_text(spark, output, text)
    return text
