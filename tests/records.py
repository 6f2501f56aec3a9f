"""Records and files for the tests."""

from __future__ import annotations

import json

RECORD = {
    "task_id": "task-1",
    "domain": "mathematics",
    "difficulty": "medium",
    "task_shape": "short-text",
    "capability_tags": ["reasoning"],
    "user_request": "Add two numbers",
    "context": "No calculator",
    "success_criteria": ["the sum is right"],
    "plan": ["add"],
    "reasoning_summary": "Addition",
    "final_answer": "4",
    "self_check": ["counted again"],
    "quality_notes": ["short"],
}


def record(task_id="task-1", **changed):
    return {**RECORD, "task_id": task_id, **changed}


def without(name, task_id="task-1"):
    return {k: v for k, v in record(task_id).items() if k != name}


def line(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def write_file(path, values, end="\n") -> str:
    path.write_text("".join(line(v) + end for v in values), encoding="utf-8", newline="")
    return str(path)
