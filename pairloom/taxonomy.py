"""The four classification axes, as plain values and as a small DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame, SparkSession

Taxonomy = Mapping[str, Mapping[str, str]]

# Axis -> value -> description, in the published order.
TAXONOMY: Taxonomy = {
    "domain": {
        "software-engineering": "Code writing, debugging, architecture, DevOps",
        "data-science": "Statistics, ML, data analysis, visualization",
        "mathematics": "Math problems, proofs, numerical computation",
        "natural-science": "Physics, chemistry, biology, earth science",
        "finance": "Stocks, investment, financial products, quantitative analysis, risk management",
        "business": "Strategy, marketing, business analysis, operations",
        "legal-compliance": "Legal interpretation, regulatory compliance, contract review",
        "education": "Educational material creation, curriculum design, assessment",
        "creative-writing": "Fiction, poetry, copywriting, screenwriting",
        "technical-writing": "Documentation, API docs, manuals, reports",
        "linguistics": "Translation, grammar, language analysis, multilingual tasks",
        "philosophy-ethics": "Ethical judgment, argumentation, thought experiments",
        "general-knowledge": "Common knowledge, history, culture, current affairs",
    },
    "capability": {
        "reasoning": "Logical reasoning, causal analysis",
        "knowledge-recall": "Factual knowledge retrieval",
        "generation": "Creating new content from scratch",
        "transformation": "Converting input to another form (summarization, translation, format change)",
        "evaluation": "Quality judgment, comparative analysis, critique",
        "planning": "Plan formulation, step decomposition, strategy",
        "problem-solving": "Deriving solutions under constraints",
        "instruction-following": "Accurately executing complex instructions",
    },
    "difficulty": {
        "easy": "Single step, clear correct answer",
        "medium": "2-3 steps, some judgment required",
        "hard": "Multi-step, ambiguity present, expert knowledge required",
    },
    "task_shape": {
        "short-text": "1-3 sentence response",
        "long-text": "Multi-paragraph structured text",
        "code": "Programming code",
        "structured-data": "JSON, tables, lists, or other structured data",
        "analysis-report": "Report with analysis, conclusions, and supporting evidence",
        "step-by-step": "Sequential procedure or guide",
    },
}

# The capability axis is carried by a list column, the others by a text column each.
AXIS_COLUMNS = ("domain", "difficulty", "task_shape")
TAG_AXIS = "capability"
TAG_COLUMN = "capability_tags"


def axis_values(axis: str, taxonomy: Taxonomy = TAXONOMY) -> list[str]:
    return list(taxonomy[axis])


def taxonomy_frame(spark: SparkSession, taxonomy: Taxonomy = TAXONOMY) -> DataFrame:
    """`(axis, ord, value, description)`, one row per taxonomy value."""
    rows = [
        (axis, ord_, value, text)
        for axis, values in taxonomy.items()
        for ord_, (value, text) in enumerate(values.items())
    ]
    return spark.createDataFrame(
        rows, "axis string, ord int, value string, description string"
    )


def cell_frame(
    spark: SparkSession, axes: Sequence[str], taxonomy: Taxonomy = TAXONOMY
) -> DataFrame:
    """Every combination of values on `axes`, with `ord_<axis>` for ordering.

    The grid is the product of fixed word lists (39 cells for two axes, 1,872 for all
    four); its size has nothing to do with the data.
    """
    rows = [
        tuple(v for _, v in cell) + tuple(o for o, _ in cell)
        for cell in product(*(enumerate(taxonomy[a]) for a in axes))
    ]
    columns = [f"`{a}` string" for a in axes] + [f"`ord_{a}` int" for a in axes]
    return spark.createDataFrame(rows, ", ".join(columns))
