"""Quality of texts learned from trusted positives and unlabelled web text.

Positive-unlabelled learning: the risk of a classifier is estimated without negatives as the
positives' own risk plus what the unlabelled texts cost as negatives, less what the positives among
them would; where that difference falls below zero it is held at zero (non-negative risk), and the
step goes against it. The share of positives among the unlabelled, the class prior, is estimated on
rows kept apart: high scores are nearly all positive, so it is the least ratio of the shares of
unlabelled and of positive texts above a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropsieve.llm.common import (
    arrow_map,
    byte_prefix,
    fold,
    parts,
    per_text,
    span_hash,
    with_text,
)
from dropsieve.llm.common import words as split_words
from dropsieve.llm.linear import Steps, adam, only, sample_ids, score, sigmoid
from dropsieve.llm.rules import measure

_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_OTHER = ~(_ALPHA | _DIGIT)
_OTHER[[9, 10, 11, 12, 13, 32]] = False

FEATURES = (
    "log_words",
    "chars_per_word",
    "symbols_per_word",
    "signs_per_word",
    "upper_share",
    "digit_share",
    "lone_signs",
    "ends_in_sign",
    "distinct_share",
    "same_as_previous",
    "same_as_second",
    "repeated_windows",
    "repeated_lines",
    "words_per_line",
)


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for every text of a slice; zeros for a text without words."""
    n = len(off) - 1
    m = measure(buf, off)
    start, end, text = split_words(buf, off)
    some = np.maximum(m["n_words"], 1).astype(np.float64)
    size = np.maximum(per_text(_ALPHA[buf], off), 1)

    def share(flags: np.ndarray, of: np.ndarray = text) -> np.ndarray:
        return np.bincount(of[flags], minlength=n) / some

    word = span_hash(byte_prefix(buf), start, end)
    _, first = np.unique(with_text(word, text), return_index=True)
    same1, same2 = np.zeros(len(word), bool), np.zeros(len(word), bool)
    same1[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    same2[2:] = (word[2:] == word[:-2]) & (text[2:] == text[:-2])
    letters = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_ALPHA[buf] | _DIGIT[buf], out=letters[1:])
    lone = letters[end] == letters[start]
    last = buf[end - 1] if len(end) else buf[:0]
    sign = _OTHER[last] & (last != ord(".")) & (last != ord(","))
    cols = [
        np.log1p(m["n_words"]),
        m["word_chars"] / some,
        m["n_symbols"] / some,
        per_text(_OTHER[buf], off) / some,
        m["n_upper"] / size,
        per_text(_DIGIT[buf], off) / some,
        share(lone),
        share(sign),
        np.bincount(text[first], minlength=n) / some,
        share(same1),
        share(same2),
        m["n_repeat_words"] / some,
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
        m["n_words"] / np.maximum(m["n_lines"], 1),
    ]
    return np.stack(cols, axis=1).astype(np.float64)


def column_features(col: pa.Array) -> np.ndarray:
    rows = [features(buf, off) for _, _, buf, off in parts(col)]
    return np.concatenate(rows or [np.zeros((0, len(FEATURES)))])


@dataclass
class Model:
    steps: Steps | None
    weights: np.ndarray | None
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return score(self.steps(x), self.weights)


def fit_nonnegative(
    pos: np.ndarray, unl: np.ndarray, prior: float, ridge: float = 1e-3, steps: int = 500
) -> np.ndarray:
    """Weights of least non-negative unbiased logistic risk."""
    pos, unl = (np.hstack([x, np.ones((len(x), 1), x.dtype)]) for x in (pos, unl))

    def grad(w: np.ndarray) -> np.ndarray:
        w = w.astype(pos.dtype)
        sp, su = sigmoid(pos @ w), sigmoid(unl @ w)
        positive = prior * (pos.T @ (sp - 1)) / len(pos)
        # Risk of taking all for negative, without what positives contribute to it.
        rest = np.mean(np.logaddexp(0, unl @ w)) - prior * np.mean(np.logaddexp(0, pos @ w))
        negative = unl.T @ su / len(unl) - prior * (pos.T @ sp) / len(pos)
        return (positive + negative if rest >= 0 else -negative) + ridge * np.append(w[:-1], 0)

    return adam(grad, pos.shape[1], steps, 0.02)


def estimated_prior(pos: np.ndarray, unl: np.ndarray, least: float = 0.2) -> float:
    """Share of positives among the unlabelled, from scores of rows kept apart.

    The least ratio of the two shares above a score, over scores that at least ``least`` of the
    positives reach, each share given room for its sampling error.
    """
    if not len(pos) or not len(unl):
        return 0.5
    at = np.quantile(pos, np.linspace(0, 1 - least, 50))
    p = 1 - np.searchsorted(np.sort(pos), at, "left") / len(pos)
    u = 1 - np.searchsorted(np.sort(unl), at, "left") / len(unl)
    room = np.sqrt(p * (1 - p) / len(pos)) + np.sqrt(u * (1 - u) / len(unl))
    k = np.argmin((u + room) / p)
    return float(np.clip(u[k] / p[k], 0.01, 0.99))


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    unlabelled: DataFrame,
    rows: int = 10_000,
    prior: float | None = None,
) -> Model:
    """Learns from the texts of the doc_ids in ``trusted`` and ``unlabelled``.

    Of each at most ``rows`` rows take part, those of the lowest hash of doc_id; their features, 14
    numbers a row, go to the driver. Without trusted rows all texts score the prior.
    """
    ids = sample_ids(trusted.select("doc_id").distinct(), rows).withColumn("positive", F.lit(True))
    ids = ids.unionByName(
        sample_ids(unlabelled.select("doc_id"), rows).withColumn("positive", F.lit(False))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = column_features(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("positive"), pa.array(list(x), pa.list_(pa.float64()))],
                ["doc_id", "positive", "x"],
            )

    texts = only(docs.select("doc_id", "text"), ids).select("doc_id", "positive", "text")
    got = arrow_map(texts, run, "doc_id long, positive boolean, x array<double>").toPandas()
    got = got.sort_values(["positive", "doc_id"])
    x = np.stack(got["x"]) if len(got) else np.zeros((0, len(FEATURES)))
    is_pos = got["positive"].to_numpy(bool)
    if not is_pos.any() or is_pos.all():
        return Model(None, None, 0.5 if prior is None else prior)
    steps = Steps(x[~is_pos])
    pos, unl = steps(x[is_pos]), steps(x[~is_pos])
    if prior is None:
        # Positives against unlabelled on one half of the rows, the estimate on the other half.
        a = fit_nonnegative(pos[::2], unl[::2], 0.5)
        prior = estimated_prior(score(pos[1::2], a), score(unl[1::2], a))
    return Model(steps, fit_nonnegative(pos, unl, prior), prior)


def predict(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted for every row, from its whole text alone.

    Null and empty texts get the score of a text without words. Repeated rows are scored each;
    columns other than doc_id and text are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.score(column_features(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return arrow_map(texts, run, "doc_id long, score double, predicted int")


def learning_ids(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trusted positives and unlabelled rows outside the held-out fold."""
    seen = labels.where(f"quality IS NOT NULL AND {fold()} <> 0").groupBy("doc_id")
    trusted = seen.agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    return trusted, docs.where(f"{fold()} <> 0").select("doc_id")
