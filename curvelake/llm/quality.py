"""Quality scores by learning from positives and unlabelled text (non-negative unbiased risk).

Trusted positives P and unlabelled text U give the risk of a score g without a negative example:
prior * R_P(+1) + max(0, R_U(-1) - prior * R_P(-1)). The prior, the share of positives in U, is estimated from both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import words_of
from curvelake.llm.rules import measure
from curvelake.session import materialize

#: The fit reads at most about so many rows labelled 1, chosen by a hash of the id. Unlabelled rows have no bound.
POSITIVES = 12_000

FEATURES = ("symbols", "exclaimed", "repeated", "dup_lines", "upper", "digits", "few_different", "word_length", "short", "pipes")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and FEATURES, each from 0 to 1, of the whole text; null texts count as empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    w = words_of(F.col("text"))
    length = F.greatest(F.length("text"), F.lit(1))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    letters = F.greatest(F.length(F.regexp_replace("text", r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", "")), F.lit(1))
    wide = rows.withColumns(
        {
            "_upper": F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")) / letters,
            "_digits": count("[0-9]") / length,
            "_different": F.size(F.array_distinct(w)),
            "_pipes": count("[|]"),
        }
    )
    n = F.greatest("n_words", F.lit(1))
    part = lambda c: F.least(c.cast("double"), F.lit(1.0))
    # texts of any length repeat common words: half of the square root of the length is a low number of different ones
    few = 1 - F.col("_row._different") / F.least(n, F.lit(200))
    return measure(wide, row=True).select(
        "doc_id",
        part(F.col("n_symbols") / n).alias("symbols"),
        part(F.col("n_exclaimed") / n).alias("exclaimed"),
        part(F.col("n_repeat_words") / n).alias("repeated"),
        part(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_lines"),
        part(F.col("_row._upper")).alias("upper"),
        part(10 * F.col("_row._digits")).alias("digits"),
        F.greatest(F.lit(0.0), few).alias("few_different"),
        part(F.abs(F.col("word_chars") / n - 5.5) / 10).alias("word_length"),
        F.when(F.col("n_words") < 20, (20 - F.col("n_words")) / 20.0).otherwise(0.0).alias("short"),
        part(F.col("_row._pipes") / n).alias("pipes"),
    )


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float
    prior: float

    def score(self) -> Column:
        """Probability of label 1 from the feature columns."""
        z = F.lit(self.bias)
        for name, weight in zip(FEATURES, self.weights):
            z = z + F.col(name) * weight
        return 1 / (1 + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _sums(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of rows, and sums of the loss as negatives, its slopes and its curvature."""
    z = x @ w
    s = _sigmoid(z)
    return np.concatenate([[len(x), np.logaddexp(0, z).sum()], x.T @ s, (x.T @ (x * (s * (1 - s))[:, None])).ravel()])


def _above(x: np.ndarray, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of rows, and of those whose score is at a cut or above; a cut's own ties count whatever the rounding."""
    z = x @ w
    return np.array([len(x), *(np.count_nonzero(z >= c - 1e-9) for c in cuts)], float)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


class Spread:
    """Rows of feature columns on the cluster: a sum over all of them is one pass, and one row per task and number."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select(*FEATURES)

    def total(self, of, *given) -> np.ndarray:
        def part(batches):
            total = 0
            for batch in batches:
                total = total + of(_with_one(batch.to_numpy(float)), *given)
            if np.ndim(total):
                yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

        parts = self.rows.mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        return np.array([r["v"] for r in sorted(parts.collect(), key=lambda r: r["i"])])


class Held:
    """The same over an array with the column of ones."""

    def __init__(self, x: np.ndarray):
        self.x = x

    def total(self, of, *given) -> np.ndarray:
        return of(self.x, *given)


def _means(total: np.ndarray, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    total = total[1:] / total[0]
    return total[0], total[1 : size + 1], total[size + 1 :].reshape(size, size)


def _newton(at, size: int, steps: int) -> np.ndarray:
    """Newton's method from zero with halved steps. ``at`` gives value, slopes and curvature, or an infinite value where a
    step must not go. Ends when a step gains less than a millionth."""
    w = np.zeros(size)
    value, slopes, curvature = at(w)
    for _ in range(steps):
        move, share, gained = -np.linalg.solve(curvature, slopes), 1.0, 0.0
        while share > 1e-3:
            there = at(w + share * move)
            if there[0] < value:
                gained, w = value - there[0], w + share * move
                value, slopes, curvature = there
                break
            share /= 2
        if gained < 1e-6:
            break
    return w


def estimate_prior(p: np.ndarray, u: np.ndarray | Spread, steps: int = 12, decay: float = 1e-4) -> float:
    """Share of positives in u: the least ratio of u's mass to p's over the upper level sets of a score that tells p from u.

    Where only positives live the ratio is the share itself; elsewhere it is larger. All rows of u count.
    """
    u, size = Held(u) if isinstance(u, np.ndarray) else u, p.shape[1]

    def at(w: np.ndarray):
        loss, slopes, curvature = _means(u.total(_sums, w), size)
        _, own, bend = _means(_sums(p, w), size)
        value = np.logaddexp(0, -(p @ w)).mean() + loss + decay / 2 * w @ w
        return value, own - p.mean(axis=0) + slopes + decay * w, bend + curvature + decay * np.eye(size)

    w = _newton(at, size, steps)
    cuts = np.quantile(p @ w, np.linspace(0.02, 0.8, 40))
    inside, outside = u.total(_above, w, cuts), _above(p, w, cuts)
    return float(np.clip((inside[1:] / inside[0] / np.maximum(outside[1:] / outside[0], 1e-9)).min(), 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray | Spread, prior: float | None = None, steps: int = 20, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk under the logistic loss; p and u without a column of ones.

    A step that would take the estimate of the negatives' risk below zero is halved until it does not: there the estimate
    would only fall further by fitting noise. All rows of u count in every step.
    """
    p, u = _with_one(p), Held(_with_one(u)) if isinstance(u, np.ndarray) else u
    size = p.shape[1]
    prior = estimate_prior(p, u.x if isinstance(u, Held) else u) if prior is None else prior

    def at(w: np.ndarray):
        z = p @ w
        loss, slopes, curvature = _means(u.total(_sums, w), size)
        negatives = loss - prior * np.logaddexp(0, z).mean()
        value = prior * np.logaddexp(0, -z).mean() + negatives + decay / 2 * w @ w
        return (value if negatives >= 0 else np.inf), slopes - prior * p.mean(axis=0) + decay * w, curvature + decay * np.eye(size)

    # rounded: sums of another order of rows give the same model
    w = np.round(_newton(at, size, steps), 6)
    return Model(tuple(float(x) for x in w[:-1]), float(w[-1]), prior)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that no label is learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _train(known: DataFrame, labels: DataFrame, prior: float | None, positives: int) -> Model:
    use = known.where(F.col("doc_id").isNotNull() & ~held_out())
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", "quality")
    good = marked.where("quality = 1").select("doc_id").distinct().where(~held_out())
    n = good.count()
    if n > positives:
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(positives / n * (1 << 32)))
    p = use.join(good, "doc_id", "left_semi").select(*FEATURES).toPandas().to_numpy(float)
    u = use.join(marked.select("doc_id"), "doc_id", "left_anti").select(*FEATURES)
    u = materialize(u)
    if not len(p) or u.isEmpty():
        return Model((0.0,) * len(FEATURES), 0.0, 0.5)
    return fit(p, Spread(u), prior)


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES) -> Model:
    """Fit on documents outside the held-out fold: those labelled 1 against all those without a label.

    Labelled-0 rows are not used. At most about ``positives`` of the rows labelled 1 are read, chosen by a hash of the id; every
    unlabelled row counts, in the prior and in each step. Without positives or without unlabelled rows, all documents get
    the prior 0.5 as score. Rows without an id are not learned from.
    """
    return _train(materialize(features(docs)), labels, prior, positives)


def _scored(known: DataFrame, model: Model, threshold: float) -> DataFrame:
    rows = known.select("doc_id", model.score().alias("score"))
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Only the text decides.

    Null and empty texts are scored too, alike; repeated rows each; texts of any length whole. An empty table gives an empty one.
    """
    return _scored(features(docs, id_col, text_col), model, threshold)


def classify(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES, threshold: float = 0.3) -> DataFrame:
    """``train`` and ``score`` on the same documents, whose features are measured and written once."""
    known = materialize(features(docs))
    return _scored(known, _train(known, labels, prior, positives), threshold)
