"""Small awkward inputs and brute-force comparisons for the operators' tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __key string, id int"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """`(doc_id, text, source)` as documents, with two columns of clashing names."""
    full = [
        (i, t, "en", s, None if t is None else len(t), "clash", k)
        for k, (i, t, s) in enumerate(rows)
    ]
    return spark.createDataFrame(full, DOCS).repartition(3)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, repeated rows, a very long text."""
    sentence = "The quick brown fox jumps over the lazy dog near the old river bank today. "
    return documents(
        spark,
        [
            (1, "Some words of a short text", "a"),
            (2, "", "a"),
            (3, None, None),
            (4, "Some words of a short text", "b"),
            (4, "Some words of a short text", "b"),
            (None, "A text without an id", "a"),
            (None, None, None),
            (5, "   \n\t ", "b"),
            (6, sentence * 4000, "c"),
            (2**60, "é" * 50 + "\x00 end", "a"),
            (2**60 + 1, "é" * 50 + "\x00 end", "a"),
        ],
    )


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in an order that bears nulls."""
    key = lambda row: [(v is None, str(type(v)), v) for v in row]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def components(n: int, linked) -> list[int]:
    """The smallest index that each of n items reaches; `linked(i, j)` for i < j."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
