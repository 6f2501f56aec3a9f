"""Record checks: one line in, status, reason and offending element out."""

import re

import pytest

from pairloom.functions.record import checked_lines, reject_details
from pairloom.functions.text import WHITE_SPACE
from pairloom.schema import OPTIONAL_LISTS, REQUIRED_LISTS, REQUIRED_TEXT
from pairloom.session import engine_settings
from tests.records import line, record, without


@pytest.fixture(scope="module")
def judge(spark, tmp_path_factory):
    def run(values):
        rows = [(i, line(v)) for i, v in enumerate(values)]
        lines = spark.createDataFrame(rows, "n int, value string")
        with engine_settings(spark):
            found = checked_lines(lines).orderBy("n").collect()
        return found

    return run


def reasons(rows):
    return [r.reason or r.status for r in rows]


def test_missing_and_mistyped_fields(judge):
    names = REQUIRED_TEXT + REQUIRED_LISTS
    rows = judge([without(n) for n in names] + [record(**{n: 5}) for n in names])
    assert reasons(rows) == [f"missing:{n}" for n in names] + [f"type:{n}" for n in names]
    assert all(r.rec is None for r in rows)


def test_null_is_present_but_of_the_wrong_type(judge):
    names = REQUIRED_TEXT + REQUIRED_LISTS + OPTIONAL_LISTS
    rows = judge([record(**{n: None}) for n in names])
    assert reasons(rows) == [f"type:{n}" for n in names]


def test_lists_hold_strings_only(judge):
    names = REQUIRED_LISTS + OPTIONAL_LISTS
    bad = [["a", 1], ["a", None], [None], [["a"]], [{}], "a", {"a": 1}, 1.5, True]
    rows = judge([record(**{n: value}) for n in names for value in bad])
    assert reasons(rows) == [f"type:{n}" for n in names for _ in bad]


def test_optional_lists(judge):
    rows = judge([record(), record(references=[], artifacts=["a", "b"])])
    assert reasons(rows) == ["ok", "ok"]
    assert (rows[0].rec.references, rows[0].rec.artifacts) == (None, None)
    assert (rows[1].rec.references, rows[1].rec.artifacts) == ([], ["a", "b"])


def test_taxonomy(judge):
    rows = judge(
        [
            record(domain="other"),
            record(difficulty="Easy"),
            record(task_shape=""),
            record(capability_tags=["reasoning", "telepathy"]),
            record(capability_tags=[]),
            record(capability_tags=["planning", "planning"]),
        ]
    )
    assert reasons(rows) == [
        "enum:domain",
        "enum:difficulty",
        "enum:task_shape",
        "enum:capability_tags",
        "ok",
        "ok",
    ]


def test_first_failing_check_gives_the_reason(judge):
    both = record(domain="other", context=5)
    rows = judge([both, {**both, "plan": "x"}, record(domain="other", plan=[1])])
    assert reasons(rows) == ["type:context", "type:context", "type:plan"]


@pytest.mark.parametrize(
    "text",
    [
        "{not valid json",
        line(record()) + " junk",
        line(record()) + "{}",
        line(record()) + "] junk",
        line(record()) + ",{}",
        line(record()) + ',"x"',
        line(record()) + ',"x"] ',
        line(record()) + ",",
        "," + line(record()),
        "[1]",
        "[" + line(record()) + "]",
        "5",
        '"x"',
        "true",
        "{'task_id':'x'}",
        '{"a":01}',
        '{"a":"tab\there"}',
        '{"a":NaN}',
    ],
)
def test_not_a_json_object(judge, text):
    assert reasons(judge([text])) == ["json"]


def test_null_and_empty_objects_lack_the_first_field(judge):
    assert reasons(judge(["null", "{}", " {} "])) == ["missing:task_id"] * 3


def test_blank_lines_and_outer_white_space(judge):
    good = line(record())
    padded = [c + good + c for c in WHITE_SPACE]
    rows = judge(["", *WHITE_SPACE, WHITE_SPACE, *padded, "​"])
    assert [r.status for r in rows] == (
        ["blank"] * (2 + len(WHITE_SPACE)) + ["ok"] * len(padded) + ["failed"]
    )


def test_unknown_keys_are_ignored_and_keys_are_case_sensitive(judge):
    rows = judge(
        [record(id=7, created_at=1, extra={"a": [1]}), {**without("plan"), "Plan": ["a"]}]
    )
    assert reasons(rows) == ["ok", "missing:plan"]


def test_last_of_duplicate_keys_counts(judge):
    body = line(record("last"))[1:]
    rows = judge(['{"task_id":5,"task_id":"first",' + body, line(record())[:-1] + ',"plan":1}'])
    assert rows[0].rec.task_id == "last"
    assert reasons(rows) == ["ok", "type:plan"]


def test_nul_character_cannot_be_stored(judge):
    rows = judge(
        [
            record(final_answer="a\x00b"),
            record(plan=["a", "\x00"]),
            record(references=["\x00"]),
            record(extra="\x00"),
            record(final_answer="\\u0000"),
        ]
    )
    assert reasons(rows) == ["nul", "nul", "nul", "ok", "ok"]
    assert rows[4].rec.final_answer == "\\u0000"


def test_texts_are_kept_as_they_are(judge):
    text = ' quoted "x" \\ / \n\t é 漢字 \U0001f600 ' + "z" * 300_000
    rows = judge([record(final_answer=text, plan=[text, ""])])
    assert rows[0].rec.final_answer == text
    assert rows[0].rec.plan == [text, ""]


def test_reject_details(spark):
    cases = [
        ("enum:capability_tags", record(capability_tags=["reasoning", "x", "y"]), "enum", 1),
        ("type:plan", record(plan=["a", "b", 3]), "field", 2),
        ("type:plan", record(plan=[None, "b"]), "field", 0),
        ("type:plan", record(plan="a"), "field", None),
        ("missing:plan", without("plan"), "field", None),
        ("json", "{", "json", None),
        ("nul", record(plan=["\x00"]), "insert", None),
    ]
    rows = [(i, c[0], line(c[1])) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "n int, reason string, value string")
    found = reject_details(df).orderBy("n").collect()
    assert [(r.stage, r.element) for r in found] == [(c[2], c[3]) for c in cases]


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = checked_lines(lines)._jdf.queryExecution().explainString(mode)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) == 2 and max(sizes) < 8000
