"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled 1, the unlabelled set is web text at large. A small network
over statistics of the text minimises the non-negative risk: with class prior p and losses of the
positives (as positive, as negative) and of the unlabelled as negative,
``p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))``; where the second term falls below zero its
gradient is reversed, which keeps a flexible model from overfitting. The prior is estimated from
positives against unlabelled rows: of all thresholds of a first network the least ratio of what
passes. Where rows labelled 0 are at hand, they give the prior (the share of label 1) and a
two-parameter logistic fit of the score; nothing else is learnt from them.

Learnt from about ``POSITIVES`` labelled and ``UNLABELLED`` other documents, drawn by hash (of the
id, of id and text) from rows that may be learnt from; every document is scored from its whole text.

Defined results: null text counts as empty; repeated rows give a row each; of several labels of
an id the smallest counts; without positive labels, or without other rows, every score is the prior
(1 if there are no labels at all); texts of any length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out

POSITIVES = 20_000
UNLABELLED = 10_000
THRESHOLD = 0.7
HIDDEN = 12
_CLASS = np.zeros(256, np.int64)  # byte classes: 0 lower, 1 upper, 2 digit, 3 blank, 4 . , 5 other symbols, 6 non-ASCII
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 6 if _b > 127 else 1 if _c.isupper() else 0 if _c.islower() else 2 if _c.isdigit() else 3 if _c.isspace() else 4 if _c in ".," else 5


def features(text: str | None) -> list[float]:
    """Shares that do not depend on the length of the text, on a log scale, and its length."""
    data = (text or "").encode()
    size = max(1, len(data))
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    by_class = np.bincount(_CLASS, by_byte, 7)
    words = data.split()
    n = max(1, len(words))
    lines = data.split(b"\n")
    firsts = sum(map(eq, words, words[1:]))
    shares = [
        *(by_class / size),
        by_byte[ord("|")] / size,
        by_byte[ord("!")] / size,
        by_byte[[ord(c) for c in "#$%&*"]].sum() / size,
        by_byte.max() / size,
        firsts / n,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(words)) / n,
        sum(w.isupper() for w in words) / n,
        sum(w.isalpha() for w in words) / n,
    ]
    return [*np.log1p(100 * np.array(shares)).tolist(), float(np.log1p(len(words))), float(np.log1p(len(data) / n))]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["quality", "x"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Non-negative risk of the outputs for positives and unlabelled rows, and the slopes to follow.

    Sigmoid loss: of z as positive s(-z), as negative s(z); its slope is s(z) (1 - s(z)). Where the
    unlabelled part would be negative its slope is reversed, and the positives' own part rests.
    """
    s_p, s_u = _sigmoid(z_p), _sigmoid(z_u)
    negative = s_u.mean() - prior * s_p.mean()
    slope_p, slope_u = s_p * (1 - s_p) / len(s_p), s_u * (1 - s_u) / len(s_u)
    value = prior * (1 - s_p).mean() + max(0.0, negative)
    return (value, -2 * prior * slope_p, slope_u) if negative >= 0 else (value, prior * slope_p, -slope_u)


class Model:
    """Standardisation, one hidden layer, and the logistic fit of its output."""

    def __init__(self, prior: float):
        self.prior, self.weights = prior, None

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600) -> None:
        """Minimise the risk on the two sets; the score is the network's output as it is."""
        every = np.concatenate((positive, unlabelled))
        self.mean, self.spread = every.mean(0), every.std(0) + 1e-6
        rng = np.random.default_rng(7)
        d = every.shape[1]
        w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
        xp, xu = self._scaled(positive), self._scaled(unlabelled)
        for step in range(1, steps + 1):
            hp, hu = np.tanh(xp @ w[0] + w[1]), np.tanh(xu @ w[0] + w[1])
            _, gp, gu = risk(hp @ w[2] + w[3], hu @ w[2] + w[3], self.prior)
            grads = [0.0] * 4
            for x, h, g in ((xp, hp, gp), (xu, hu, gu)):
                back = np.outer(g, w[2]) * (1 - h * h)
                for i, part in enumerate((x.T @ back, back.sum(0), h.T @ g, np.array([g.sum()]))):
                    grads[i] = grads[i] + part
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.02 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
        self.weights, self.scale = w, (1.0, 0.0)

    def calibrate(self, labelled: np.ndarray, labels: np.ndarray) -> None:
        """Fit the score to rows of both labels."""
        self.scale = _logistic(self._raw(labelled), labels)

    def estimate_prior(self, positive: np.ndarray, unlabelled: np.ndarray) -> float:
        """The share of positives among the unlabelled that a trained network cannot rule out: of all
        thresholds the least ratio of what passes among them to what passes among positives."""
        z_p, z_u = np.sort(self._raw(positive)), np.sort(self._raw(unlabelled))
        cuts = z_p[: max(1, int(len(z_p) * 0.8))]  # a fifth of the positives pass at least
        passed = lambda z: 1 - np.searchsorted(z, cuts, "left") / len(z)
        return float(np.clip((passed(z_u) / passed(z_p)).min(), 0.01, 0.99))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def _raw(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(self._scaled(x) @ w[0] + w[1]) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        a, b = self.scale
        return _sigmoid(a * self._raw(x) + b)


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a little weight towards no slope."""
    x, w = np.stack((z, np.ones_like(z)), 1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
    return float(max(w[0], 1e-6)), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, calibrated: bool = True) -> Model:
    """The model; ``calibrated`` lets negative labels, where there are any, set the prior and the scale."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = lambda rows, n, *of: F.pmod(F.xxhash64(*of), F.lit(max(1, rows // n))) == 0
    # About `positives` ids and labels, twice as many at most.
    sample = known.filter(drawn(labels.count(), positives, "doc_id")).select(F.col("doc_id").alias("_id"), "quality").limit(2 * positives)
    plain = docs.select("doc_id", "text")
    rows = plain.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"), "left").filter(
        F.col("quality").isNotNull() | (~held_out() & drawn(docs.count(), unlabelled, "doc_id", "text"))
    )
    # Bounded by the two parameters, whatever ids and texts repeat: some twenty numbers a row.
    got = rows.select(F.col("quality").cast("int").alias("quality"), "text").mapInArrow(_features, "quality int, x array<double>")
    got = got.limit(4 * (positives + unlabelled)).toPandas()
    if not len(got):
        return Model(1.0)
    x = np.array(got["x"].tolist(), float)
    y = got["quality"].to_numpy(float, na_value=np.nan)
    order = np.lexsort((*x.T, np.nan_to_num(y, nan=2.0)))  # the rows arrive in any order
    x, y = x[order], y[order]
    has, good = ~np.isnan(y), x[y == 1]
    negatives = calibrated and (y == 0).any()
    model = Model(float(y[has].mean()) if negatives or not len(good) and has.any() else 1.0)
    # Web text at large: what is not labelled, and the labelled rows in their natural mix.
    if len(good) and negatives:
        model.fit(good, x)
        model.calibrate(x[has], y[has])
    elif len(good) and len(x) > len(good):
        model.prior = 0.5
        model.fit(good, x[y != 1])
        model.prior = model.estimate_prior(good, x[y != 1])
        model.fit(good, x[y != 1])
    return model


def _scored(model: Model, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(2)], float).reshape(batch.num_rows, -1)
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    return run


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = learn(docs, labels)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_scored(model, threshold), "doc_id bigint, held_out boolean, score double, predicted int")


def _kept(model: Model, threshold: float, at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(at)], float).reshape(batch.num_rows, -1)
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Whole rows of the documents that the classifier does not reject."""
    return docs.mapInArrow(_kept(learn(docs, labels), threshold, docs.columns.index("text")), docs.schema)
