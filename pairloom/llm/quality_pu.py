"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that is learned from; negative labels are
never read. The class prior is estimated first: a preliminary model tells positives from
unlabelled text, and over the sets of best-scored rows the share of unlabelled text
divided by the share of held-back positives is least where only positives are left, which
gives the prior (best-bin estimate with a confidence term). Then a linear model minimises
the non-negative unbiased risk: `prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))` with
logistic loss; where the second part falls under zero, its own gradient is undone.

Inputs of a score are computed from the whole text only: how often each pair of byte
classes (letters, capitals, digits, marks, ...) follows one another, and how words and
lines repeat. Nothing depends on language, source or id.

The model is fitted in the driver on at most `max_positives` and `max_unlabelled` rows, those
with the smallest hash of their id; everything else is one pass over the documents without
a shuffle of text. The fitted model is some hundred numbers.

Defined cases: null text is empty text and gets a score like any other. Rows of labels that
are null or not 1 are ignored; repeated labels of an id count once. Without any positive
label there is nothing to learn, and every score is the prior 0.5. Repeated rows get equal
scores; a null id is scored, and is no part of the sample. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, text_batches, without_ids

CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\n\r\x0b\x0c",
    b".",
    b",",
    b"!?",
    b"#$%&*@^~",
    b"|",
    b"()[]{}<>",
    b"'\"`",
    b":;-_/\\+=",
    bytes(range(0x80, 0xC0)),
    bytes(range(0xC0, 0x100)),
)
N_CLASSES = len(CLASSES) + 1
N_FEATURES = N_CLASSES * N_CLASSES + 8


def _class_table() -> np.ndarray:
    found = np.full(256, N_CLASSES - 1, dtype=np.uint16)
    for k, members in enumerate(CLASSES):
        found[np.frombuffer(members, dtype=np.uint8)] = k
    return found


def _features_of(kinds: np.ndarray, text: str | None) -> np.ndarray:
    text = text or ""
    data = kinds[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]
    pairs = np.bincount(data[:-1] * N_CLASSES + data[1:], minlength=N_CLASSES * N_CLASSES)
    out = np.zeros(N_FEATURES, dtype=np.float32)
    out[:-8] = np.sqrt(pairs / max(len(data) - 1, 1))
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    n = max(len(words), 1)
    twice = sum(map(str.__eq__, words, words[1:]))
    out[-8:] = (
        twice / n,
        np.sqrt(twice / n),
        len(set(words)) / n,
        len(set(words)) / n**0.75,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text)),
        len(text) / n if words else 0.0,
        not words,
    )
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.mean) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _risk_gradient(positive, unlabelled, prior: float, l2: float, rows: int | None = None):
    """Gradient of the non-negative risk; the last weight is the bias. A prior of 0 gives
    the plain risk of telling positives from unlabelled rows."""

    def sides(x, w):
        z = x @ w
        as_positive = 1 / (1 + np.exp(np.clip(z, -30, 30)))  # -d/dz of log(1 + e^-z)
        up, down = x.T @ -as_positive / len(x), x.T @ (1 - as_positive) / len(x)
        return np.logaddexp(0, z).mean(), up, down

    def gradient(w):
        p_minus, p_up, p_down = sides(positive, w)
        u_minus, _, u_down = sides(unlabelled, w)
        shrink = l2 * np.append(w[:-1], 0)
        if not prior:
            return p_up + u_down + shrink
        if u_minus - prior * p_minus < 0:
            return prior * p_down - u_down + shrink
        return prior * p_up + u_down - prior * p_down + shrink

    return gradient


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled scores: least ratio of the two shares over the sets
    of best-scored rows, with a Hoeffding term that rules out small sets."""
    levels = np.unique(np.quantile(positive, np.linspace(0.02, 0.98, 97)))
    p = (positive[None] >= levels[:, None]).mean(axis=1)
    u = (unlabelled[None] >= levels[:, None]).mean(axis=1)
    slack = np.sqrt(np.log(40) / 2 / len(unlabelled)) + np.sqrt(np.log(40) / 2 / len(positive))
    bound = (u + slack) / np.maximum(p, 1e-9)
    best = int(np.argmin(bound))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, l2: float = 1e-4) -> Model:
    """Fit on feature rows in random order; `unlabelled` holds positives as well."""
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p = np.hstack([(positive - mean) / scale, np.ones((len(positive), 1))])
    u = np.hstack([(unlabelled - mean) / scale, np.ones((len(unlabelled), 1))])
    half_p, half_u = max(1, len(p) // 2), max(1, len(u) // 2)
    first = _adam(_risk_gradient(p[:half_p], u[:half_u], 0, 1e-2), p.shape[1], steps // 2, 0.02)
    rest_p = p[half_p:] if len(p) > half_p else p
    rest_u = u[half_u:] if len(u) > half_u else u
    prior = estimated_prior(rest_p @ first, rest_u @ first)
    w = _adam(_risk_gradient(p, u, prior, l2), p.shape[1], steps, 0.02)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 5 == 0


def _sample_ids(ids: DataFrame, most: int, salt: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("id", F.lit(salt)), "id").limit(most)


def learn(
    docs: DataFrame,
    positives: DataFrame,
    max_positives: int = 4000,
    max_unlabelled: int = 8000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model | None:
    """Fit on `docs` and on `positives(id)`, ids of trusted positives; None without any."""
    kinds = _class_table()
    text_batches(docs.sparkSession)

    def features(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [_features_of(kinds, t.as_py()).astype("<f4").tobytes() for t in batch.column("text")]
            names = ["id", "positive", "unlabelled"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(rows, pa.binary())], [*names, "features"]
            )

    ids = docs.select(F.col(id_col).cast("long").alias("id")).filter("id is not null")
    trusted = positives.select(F.col("id").cast("long")).distinct()
    chosen = (
        _sample_ids(trusted.join(ids, "id", "left_semi"), max_positives, 1)
        .withColumn("positive", F.lit(True))
        .join(
            _sample_ids(ids.distinct(), max_unlabelled, 2).withColumn("unlabelled", F.lit(True)),
            "id",
            "full",
        )
    )
    rows = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # at most max_positives + max_unlabelled ids
        .na.fill(False, ["positive", "unlabelled"])
        .mapInArrow(features, "id long, positive boolean, unlabelled boolean, features binary")
        .dropDuplicates(["id"])
        .toPandas()
        .sort_values("id")
    )
    if not len(rows) or not rows["positive"].any():
        return None
    matrix = np.frombuffer(b"".join(rows["features"]), dtype="<f4").reshape(len(rows), -1)
    # Sorted ids may follow the order of the files; the halves of `fit` must not.
    order = np.random.default_rng(0).permutation(len(rows))
    matrix, rows = matrix[order].astype(float), rows.iloc[order]
    return fit(matrix[rows["positive"]], matrix[rows["unlabelled"]])


def _scores(model: Model | None, kinds: np.ndarray, texts) -> np.ndarray:
    rows = [_features_of(kinds, t) for t in texts]
    if model is None or not rows:
        return np.full(len(rows), 0.5)
    return model.scores(np.stack(rows))


def score(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, score)` for every row."""
    kinds = _class_table()
    text_batches(docs.sparkSession)

    def scored(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = _scores(model, kinds, [t.as_py() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], ["id", "score"])

    return (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(scored, "id long, score double")
        .withColumnRenamed("id", id_col)
    )


def without_rejected(
    docs: DataFrame,
    model: Model | None,
    threshold: float,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` with a score of at least `threshold`.

    Only ids and texts go to Python. Rows that share an id go only if all of them are
    rejected. Rows without an id, which no list of ids can name, are judged one by one.
    """
    kinds = _class_table()

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(model, kinds, texts) >= threshold)

    named, unnamed = docs.filter(F.col(id_col).isNotNull()), docs.filter(F.col(id_col).isNull())
    scores = score(named, model, id_col, text_col).groupBy(F.col(id_col).alias("id"))
    rejected = scores.agg(F.max("score").alias("best")).filter(F.col("best") < threshold)
    scratch = Scratch(docs.sparkSession, "rejected")
    stays = without_ids(named, scratch.write(rejected.select("id"), "ids"), id_col)
    return stays.unionByName(unnamed.filter(passes(text_col)))
