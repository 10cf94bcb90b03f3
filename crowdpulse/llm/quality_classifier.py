"""Quality scores learned from trusted positives and unlabelled text only (positive-unlabelled).

A linear model g over dense features and ramps of them minimises the unbiased risk
    prior * E_pos[l(g)] + max(0, E_all[l(-g)] - prior * E_pos[l(-g)])     l(z) = log(1 + exp(-z))
where "all" is every document, labelled or not, and the second part, the risk on negatives, may not
fall below zero: a Newton step that would make it negative is shortened, and learning ends there.
The class prior comes from the data: a first model tells positives from all documents; over its
scores the share of all documents above a threshold, divided by the share of positives above it
(positives the first model did not see), is least where hardly any negatives are left.

Learning uses rows whose crc32(doc_id) mod 5 is not 0, and of their labels only quality = 1. Each
step is one pass over the staged features that adds up a gradient and a Hessian per task; only sums
reach the driver. A null text counts as empty; empty texts have all-zero features and a score. A
document with several labels is a positive if all say 1. Without any positive all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm import features as X
from crowdpulse.llm.tables import fold, staged, text_of

#: Ramps end here; weight of the squared weights; Newton steps at most; bins of the prior's scores.
RAMPS, PENALTY, STEPS, BINS = (0.02, 0.1, 0.3), 0.01, 25, 1000
#: Folds whose positives only serve to estimate the class prior.
PRIOR_FOLD = 4


def expand(x: np.ndarray) -> np.ndarray:
    """The features, each also as ramps that rise to 1, and a constant."""
    return np.concatenate([np.ones((len(x), 1)), x, *(np.clip(x / t, 0, 1) for t in RAMPS)], axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((expand(x) - self.mean) / self.scale) @ self.weights


def featured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, fold, positive, x: dense features of every document."""

    @arrow_udf("array<float>")
    def run(column: pa.Array) -> pa.Array:
        x = X.of_column(column).astype(np.float32)
        return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))

    marks = labels.where("doc_id is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("positive"))
    # Labels of held-out rows go before the join.
    marks = marks.where(fold() > 0).select(F.col("doc_id").alias("_id"), "positive")
    rows = staged(docs.select("doc_id", run(text_of()).alias("x")), "features")
    joined = rows.join(marks, rows["doc_id"] == marks["_id"], "left")
    return staged(
        joined.select("doc_id", fold().alias("fold"), F.coalesce("positive", F.lit(False)).alias("positive"), "x"),
        "examples",
    )


def summed(rows: DataFrame, sums: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Total of ``sums(x, positive, fold)`` over all batches: per task, then over few tasks, then here."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().astype(float).reshape(len(batch), -1)
            flags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("positive", "fold"))
            part = sums(x, *flags)
            out = part if out is None else out + part
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["total"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = sum(np.array(v.values) for batch in batches for v in batch.column("total"))
        if isinstance(out, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["total"])

    parts = rows.select("x", "positive", "fold").mapInArrow(total, "total array<double>")
    found = parts.repartition(8).mapInArrow(merge, "total array<double>").collect()
    return sum(np.array(r.total) for r in found) if found else np.zeros(0)


def _scaling(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def sums(x, positive, fold):
        e = expand(x)
        return np.concatenate([[len(e)], e.sum(0), (e * e).sum(0)])

    total = summed(rows, sums)
    n, (s, q) = total[0], np.split(total[1:], 2)
    mean = s / n
    scale = np.sqrt(np.maximum(q / n - mean**2, 0))
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-9] = 1
    return mean, scale


def _moments(rows: DataFrame, model: Model, unseen: int):
    """Sums at the present weights over all rows and over positives outside the fold ``unseen``."""
    d = len(model.mean)

    def sums(x, positive, fold):
        e = (expand(x) - model.mean) / model.scale
        z = e @ model.weights
        s = sigmoid(z)
        p = positive & (fold > 0) & (fold != unseen)
        soft = np.logaddexp(0, z)
        hesse = (e * (s * (1 - s))[:, None]).T @ e
        seen = np.where(p, 1.0, 0.0)
        hesse_p = (e[p] * (s[p] * (1 - s[p]))[:, None]).T @ e[p]
        vectors = [e.T @ s, hesse.ravel(), e.T @ seen, e[p].T @ s[p], hesse_p.ravel()]
        return np.concatenate([[len(e), soft.sum(), seen.sum(), soft[p].sum(), (soft[p] - z[p]).sum()], *vectors])

    t = summed(rows, sums)
    n, soft, n_p, soft_p, miss_p = t[:5]
    sizes = np.cumsum([d, d * d, d, d])
    g, h, x_p, g_p, h_p = np.split(t[5:], sizes)
    n_p = max(n_p, 1)
    return soft / n, soft_p / n_p, miss_p / n_p, g / n, h.reshape(d, d) / n, x_p / n_p, g_p / n_p, h_p.reshape(d, d) / n_p


def _newton(rows: DataFrame, model: Model, prior: float | None, unseen: int = -1) -> Model:
    """Minimise the non-negative risk; without a prior, tell positives from all rows instead."""
    ridge = np.full(len(model.mean), PENALTY)
    ridge[0] = 0
    held, step = model, None
    for _ in range(STEPS):
        soft, soft_p, _, g, h, x_p, g_p, h_p = _moments(rows, model, unseen)
        if prior is not None and soft - prior * soft_p < 0:  # risk on negatives below zero
            if step is None or np.abs(step).max() < 0.05:
                return held
            step = step / 2
            model = held._replace(weights=held.weights - step)
            continue
        held = model
        if prior is None:
            gradient, hesse = (g - (x_p - g_p)) / 2, (h + h_p) / 2
        else:
            gradient, hesse = g - prior * x_p, h
        hesse = hesse + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hesse, gradient + ridge * model.weights)
        step *= min(1, 5 / max(np.abs(step).max(), 1e-12))
        model = model._replace(weights=model.weights - step)
        if np.abs(step).max() < 1e-3:
            break
    return model


def estimate_prior(rows: DataFrame, first: Model) -> float:
    """Least share of all rows above a threshold per share of unseen positives above it, with a margin."""

    def sums(x, positive, fold):
        b = np.minimum((sigmoid(first.margin(x)) * BINS).astype(int), BINS - 1)
        p = positive & (fold == PRIOR_FOLD)
        return np.concatenate([np.bincount(b, minlength=BINS), np.bincount(b[p], minlength=BINS)]).astype(float)

    everyone, positives = np.split(summed(rows, sums), 2)
    if not positives.sum():
        return 0.5
    over = lambda c: np.cumsum(c[::-1])[::-1] / c.sum()
    q_all, q_pos = over(everyone), over(positives)
    slack = np.sqrt(np.log(40) / 2 / everyone.sum()) + np.sqrt(np.log(40) / 2 / positives.sum())
    at = np.argmin(np.where(q_pos > 0, (q_all + slack) / np.maximum(q_pos, 1e-12), np.inf))
    return float(np.clip(q_all[at] / q_pos[at], 0.01, 0.99))


def fit(rows: DataFrame) -> Model | None:
    """Learn from staged rows of ``featured``; None if there is no positive."""
    if rows.where("positive and fold > 0").limit(1).count() == 0:
        return None
    mean, scale = _scaling(rows)
    zero = Model(mean, scale, np.zeros(len(mean)), 0.5)
    first = _newton(rows, zero, None, PRIOR_FOLD)
    prior = estimate_prior(rows, first)
    return _newton(rows, zero, prior)._replace(prior=prior)


def score(model: Model | None, x: Column) -> Column:
    @arrow_udf("double")
    def run(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy().astype(float).reshape(len(x), -1)
        return pa.array(sigmoid(model.margin(flat)))

    return F.lit(0.5) if model is None else run(x)


def score_text(model: Model | None, text: Column) -> Column:
    @arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(sigmoid(model.margin(X.of_column(column).astype(np.float32).astype(float))))

    return F.lit(0.5) if model is None else run(text)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, fold, score, predicted."""
    rows = featured(docs, labels)
    out = rows.select("doc_id", "fold", score(fit(rows), F.col("x")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those that score below the threshold."""
    model = fit(featured(docs, labels))
    return docs.where(score_text(model, text_of()) >= threshold)
