"""The strict report, rule by rule, and the id format."""

import pytest
from pyspark.sql import functions as F

from pairloom.operators.conform import has_timestamp_id, strict_violations
from pairloom.session import configure
from tests.records import line, record, without


@pytest.fixture
def violations(spark):
    configure(spark)

    def run(values):
        rows = [(i, line(v)) for i, v in enumerate(values)]
        df = strict_violations(spark.createDataFrame(rows, "n int, value string"))
        found = [[] for _ in values]
        for r in df.orderBy("n", "field", "rule").collect():
            found[r.n].append((r.field, r.rule))
        return found

    yield run
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")


CASES = [
    (record(), []),
    (record(references=[], artifacts=["x"]), []),
    (record(task_id=""), [("task_id", "minLength")]),
    (record(context=5), [("context", "type")]),
    (record(domain=5), [("domain", "enum"), ("domain", "type")]),
    (record(domain=""), [("domain", "enum")]),
    (without("plan"), [("plan", "required")]),
    (without("domain"), [("domain", "required")]),
    (record(plan=[]), [("plan", "minItems")]),
    (record(plan="x"), [("plan", "type")]),
    (record(plan=None), [("plan", "type")]),
    (record(plan=["a", "", ""]), [("plan", "items.minLength")]),
    (record(plan=["", 1, None]), [("plan", "items.minLength"), ("plan", "items.type")]),
    (record(capability_tags=[]), [("capability_tags", "minItems")]),
    (record(capability_tags=["x"]), [("capability_tags", "items.enum")]),
    (
        record(capability_tags=["reasoning", 1]),
        [("capability_tags", "items.enum"), ("capability_tags", "items.type")],
    ),
    (record(references=None), [("references", "type")]),
    (record(artifacts=[""]), [("artifacts", "items.minLength")]),
    (
        record(extra=1, created_at="x"),
        [("created_at", "additionalProperties"), ("extra", "additionalProperties")],
    ),
    ("{", [("", "json")]),
    (line(record()) + " x", [("", "json")]),
    ("[1]", [("", "type")]),
    ("null", [("", "type")]),
    ("   ", []),
    (line(record())[:-1] + ',"plan":["b"]}', []),
]


def test_rules(violations):
    assert violations([c[0] for c in CASES]) == [c[1] for c in CASES]


def test_empty_object_lacks_all_required_fields(violations):
    (found,) = violations(["{}"])
    assert len(found) == 13 and {rule for _, rule in found} == {"required"}


def test_id_format(spark):
    good = ["x-20250131-235959", "a-b-20240229-000000"]
    bad = [
        "-20250131-235959",
        "x-20250131-246060",
        "x-20250230-120000",
        "x-2025131-120000",
        "x-20250131-120000 ",
        "x",
        "",
        None,
    ]
    df = spark.createDataFrame([(v,) for v in good + bad], "t string")
    found = [r.ok for r in df.select(has_timestamp_id(F.col("t")).alias("ok")).collect()]
    assert found == [True] * len(good) + [False] * len(bad)
