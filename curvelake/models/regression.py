"""Polynomial regression with and without penalties, from one pass of moments.

The moments are sums of Chebyshev polynomials of x mapped to [-1, 1]. Products of two
Chebyshev polynomials are sums of two others, so 2m + 1 sums give the whole normal matrix
of degree m, and that matrix stays well conditioned at degrees where powers of x do not.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from numpy.polynomial import chebyshev, polynomial
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.likelihood import LOG_2PI, rate_at
from ..functions.scalars import ColumnLike, as_col, quoted
from ..operators.joins import attach_scalars, fresh, join_on_keys

COEF_SCHEMA = "model string, term int, value double"
FIT_SCHEMA = f"{COEF_SCHEMA}, cheb double, lo double, hi double, dropped int"

#: Directions of the normal matrix below this share of its largest eigenvalue cannot be told from rounding.
RANK_CUT = 1e-13


# --- features -------------------------------------------------------------------------

def poly_features(df: DataFrame, x: str, m: int, name: str = "features") -> DataFrame:
    """Array x, x^2, ..., x^m."""
    powers = F.transform(F.sequence(F.lit(1), F.lit(m)), lambda k: F.pow(F.col(quoted(x)), k.cast("double")))
    return df.withColumn(name, powers)


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with mean and population standard deviation of each column."""
    return df.agg(
        *[F.avg(quoted(c)).alias(f"{c}_mean") for c in cols],
        *[F.stddev_pop(quoted(c)).alias(f"{c}_sd") for c in cols],
    )


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """(value - mean) / population sd. Pass the training table's ``feature_stats`` to scale
    another table, such as a grid, in the same way. A constant column gives null."""
    stats = feature_stats(df, cols) if stats is None else stats
    needed = {f"_{c}_{s}": F.max(quoted(f"{c}_{s}")) for c in cols for s in ("mean", "sd")}
    scaled = attach_scalars(df, stats, **needed)
    return scaled.withColumns(
        {
            c: F.try_divide(F.col(quoted(c)) - F.col(quoted(f"_{c}_mean")), F.col(quoted(f"_{c}_sd")))
            for c in cols
        }
    ).drop(*needed)


# --- moments --------------------------------------------------------------------------

@dataclass(frozen=True)
class Moments:
    """Sums over a batch of groups: rows, T_k (k <= 2m), T_k y (k <= m), each with its own range of x."""

    n: np.ndarray
    t: np.ndarray
    ty: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    def gram(self, m: int) -> np.ndarray:
        i, j = np.indices((m + 1, m + 1))
        return (self.t[:, i + j] + self.t[:, np.abs(i - j)]) / 2

    def bases(self, make, m: int) -> np.ndarray:
        """A basis matrix per group; groups with equal ranges share it."""
        wide = self.hi > self.lo
        ends = np.stack([np.where(wide, self.lo, self.lo - 0.5), np.where(wide, self.hi, self.lo + 0.5)], axis=1)
        different, place = np.unique(ends, axis=0, return_inverse=True)
        return np.stack([make(m, (lo, hi)) for lo, hi in different])[place.reshape(-1)]


def moments_table(df: DataFrame, x: str, y: str, m: int, by: str | None = None) -> DataFrame:
    """One row of moments per group, in one aggregation (and one for the ranges of x, joined back by group).

    Each group has its own range: in a shared one the polynomials of a group with a narrow part would be nearly collinear.
    """
    data = df.select(
        (F.col(quoted(by)) if by else F.lit(None).cast("string")).alias("group"),
        F.col(quoted(x)).cast("double").alias("_x"),
        F.col(quoted(y)).cast("double").alias("_y"),
    ).dropna(subset=["_x", "_y"])
    if by:
        ranges = data.groupBy("group").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        scaled = join_on_keys(data, ranges, ["group"], "inner")
    else:
        scaled = attach_scalars(data, data, _lo=F.min("_x"), _hi=F.max("_x"))
    lo, hi = F.col("_lo"), F.col("_hi")
    unit = F.coalesce(F.try_divide(F.lit(2.0) * F.col("_x") - lo - hi, hi - lo), F.lit(0.0))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), unit)))
    scaled = scaled.withColumn("_angle", angle)
    wave = [F.cos(F.lit(float(k)) * F.col("_angle")) for k in range(2 * m + 1)]
    return scaled.groupBy("group").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(w) for w in wave]).alias("t"),
        F.array(*[F.sum(w * F.col("_y")) for w in wave[: m + 1]]).alias("ty"),
        F.max("_lo").alias("lo"),
        F.max("_hi").alias("hi"),
    )


def _power_basis(m: int, domain: tuple[float, float]) -> np.ndarray:
    """Columns: 1, x, ..., x^m written in Chebyshev polynomials of the mapped x."""
    lo, hi = domain
    line = np.array([(hi + lo) / 2, (hi - lo) / 2])  # x in terms of the mapped x
    basis, power = np.zeros((m + 1, m + 1)), np.array([1.0])
    for j in range(m + 1):
        as_cheb = chebyshev.poly2cheb(power)
        basis[: len(as_cheb), j] = as_cheb
        power = polynomial.polymul(power, line)
    return basis


def _chebyshev_basis(m: int, domain: tuple[float, float]) -> np.ndarray:
    """Columns: T_0, ..., T_m of the mapped x written in 1, x, ..., x^m."""
    lo, hi = domain
    line = np.array([-(lo + hi) / (hi - lo), 2 / (hi - lo)])
    basis = np.zeros((m + 1, m + 1))
    for k in range(m + 1):
        out = np.zeros(1)
        for c in chebyshev.cheb2poly(np.eye(m + 1)[k])[::-1]:
            out = polynomial.polyadd(polynomial.polymul(out, line), [c])
        basis[: len(out), k] = out
    return basis


def _times(matrices: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.einsum("gij,gj->gi", matrices, vectors)


def solve_ols(mo: Moments, m: int, alpha: float = 0.0) -> np.ndarray:
    """Least squares for every group of the batch: one row of power coefficients each."""
    return _times(mo.bases(_chebyshev_basis, m), _ols_chebyshev(mo, m)[0])


def _ols_chebyshev(mo: Moments, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squares in the mapped Chebyshev basis, and how many directions per group the rows do not settle.

    These are left out, so the coefficients are the shortest among those that fit best.
    """
    values, vectors = np.linalg.eigh(mo.gram(m))
    known = values > RANK_CUT * np.abs(values).max(axis=1, keepdims=True)
    inverse = np.where(known, 1 / np.where(known, values, 1.0), 0.0)
    along = np.einsum("gji,gj->gi", vectors, mo.ty[:, : m + 1])
    return _times(vectors, inverse * along), (~known).sum(axis=1)


def solve_ridge(mo: Moments, m: int, alpha: float) -> np.ndarray:
    """Least |y - Xw - b|^2 + alpha |w|^2 with a free intercept b."""
    values, vectors = np.linalg.eigh(mo.gram(m))
    root = np.sqrt(np.clip(values, 0, None))[:, :, None] * vectors.swapaxes(1, 2)  # root' root = gram
    target = _times(np.linalg.pinv(root.swapaxes(1, 2)), mo.ty[:, : m + 1])
    penalty = np.sqrt(alpha) * np.eye(m + 1)[1:]
    design = np.concatenate(
        [root @ mo.bases(_power_basis, m), np.broadcast_to(penalty, (len(root), m, m + 1))], axis=1
    )
    # Columns differ by orders of magnitude: solve for scaled coefficients.
    size = np.linalg.norm(design, axis=1)
    size[size == 0] = 1.0
    wanted = np.concatenate([target, np.zeros((len(root), m))], axis=1)
    return _times(np.linalg.pinv(design / size[:, None, :]), wanted) / size


def _sparse_minimum(root: np.ndarray, target: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Least |Rw - t|^2 / 2 + cost'|w| by an active set (Lawson and Hanson 1974, for coefficients of either sign).

    Coefficients enter one at a time with a fixed sign; the smooth problem of the present signs
    is solved from the singular values of R, and the move stops where a coefficient reaches 0, which then leaves. No move is
    judged by the value it gains: powers of x are almost collinear, and moves far along them gain less than rounding shows.
    What leaves at once waits until others have moved.
    """
    w, sign, waits = np.zeros(len(cost)), np.zeros(len(cost)), np.zeros(len(cost), bool)
    tol = 1e-11 * np.linalg.norm(target)
    for _ in range(100 * (len(cost) + 1)):
        slope = root.T @ (root @ w - target)
        excess = np.where((sign != 0) | waits, -np.inf, np.abs(slope) - cost)
        j, moved = int(np.argmax(excess)), False
        if excess[j] <= tol:
            break
        sign[j] = -np.sign(slope[j])
        while sign.any():
            active = np.flatnonzero(sign)
            left, size, right = np.linalg.svd(root[:, active])
            way = np.zeros_like(w)
            tied = len(size) < len(active) or size[-1] <= 1e-13 * size[0]
            if tied:  # a way along which only the cost changes: down it until a coefficient reaches 0
                way[active] = right[-1] * (-1.0 if cost[active] * sign[active] @ right[-1] > 0 else 1.0)
                leaving = active[way[active] * sign[active] < 0]
            else:
                right = right / size[:, None]
                way[active] = right.T @ (left.T[: len(active)] @ target - right @ (cost[active] * sign[active])) - w[active]
                leaving = active[(w + way)[active] * sign[active] <= 0]
            # The share of the way after which each of these reaches 0.
            shares = np.minimum(np.abs(w[leaving]) / np.maximum(np.abs(way[leaving]), 1e-300), np.inf if tied else 1.0)
            if tied and not len(leaving):
                leaving, shares = np.array([j]), np.zeros(1)
            step = shares.min(initial=np.inf if tied else 1.0)
            moved |= step > 0
            w = w + step * way
            if not len(leaving):
                break
            gone = leaving[shares <= step]
            w[gone] = sign[gone] = 0.0
        if moved:
            waits[:] = False
        waits[j] = sign[j] == 0
    slope = root.T @ (root @ w - target)
    off = np.where(w == 0, np.maximum(np.abs(slope) - cost, 0), np.abs(slope + cost * np.sign(w)))
    if off.max(initial=0.0) > 1e-6 * (1 + np.abs(root.T @ target).max(initial=0.0)) + 1e-14 * np.abs(w).sum():
        raise ValueError(f"the lasso search ended {off.max():.3g} away from its optimality conditions")
    return w


def solve_lasso(mo: Moments, m: int, alpha: float) -> np.ndarray:
    """Least |y - Xw - b|^2 / 2n + alpha |w|_1 from the moments.

    The centred normal matrix is rooted in Chebyshev polynomials, where it is well conditioned, and only its root is rewritten in powers.
    """
    basis, n = mo.bases(_power_basis, m), mo.n[:, None]
    gram, ty = mo.gram(m) / n[:, :, None], mo.ty[:, : m + 1] / n
    mean, mean_y = gram[:, 0, :], ty[:, :1]
    values, vectors = np.linalg.eigh(gram[:, 1:, 1:] - mean[:, 1:, None] * mean[:, None, 1:])
    known = values > RANK_CUT * np.einsum("gii->g", gram)[:, None]
    size = np.sqrt(np.where(known, values, 0.0))
    root = size[:, :, None] * vectors.swapaxes(1, 2) @ basis[:, 1:, 1:]
    along = np.einsum("gji,gj->gi", vectors, ty[:, 1:] - mean[:, 1:] * mean_y)
    target = np.where(known, along / np.where(known, size, 1.0), 0.0)
    sd = np.linalg.norm(root, axis=1)
    sd[sd == 0] = 1.0
    w = np.stack([_sparse_minimum(r, t, k) for r, t, k in zip(root / sd[:, None, :], target, alpha / sd)]) / sd
    return np.concatenate([mean_y - np.sum(_times(basis.swapaxes(1, 2), mean)[:, 1:] * w, axis=1, keepdims=True), w], axis=1)


# --- fits -----------------------------------------------------------------------------

def _coef_rows(model: str, w: Iterable[float]) -> list[tuple[str, int, float]]:
    return [(model, i, float(v)) for i, v in enumerate(w)]


SOLVERS = {"linear": solve_ols, "ridge": solve_ridge, "lasso": solve_lasso}


def fit_many(
    df: DataFrame, x: str, y: str, specs: Mapping[str, tuple[str, int, float]], by: str | None = None
) -> DataFrame:
    """Many models per group from the same moments, as (group, model, term, value, cheb, lo, hi, dropped).

    ``value`` is the coefficient of x^term. ``cheb`` is that of the Chebyshev polynomial T_term of x mapped from the group's [lo, hi] to [-1, 1]; it is
    what :func:`predict` uses, as powers of x far from 0 cancel each other. ``dropped`` is the number of directions that a group's rows
    do not settle (too few different x for the degree). A penalty acts on powers of x, so penalised models are solved in them and then rewritten.

    ``specs`` maps a model name to (kind, degree, alpha) with kind ``linear``, ``ridge`` or
    ``lasso``. One pass over the data serves all of them. The small systems are solved where the
    groups' moment rows lie, so the number of groups is not limited by the driver.
    """
    moments = moments_table(df, x, y, max(m for _, m, _ in specs.values()), by)
    group_type = moments.schema["group"].dataType.simpleString()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            mo = Moments(
                pdf["n"].to_numpy(float), np.stack(pdf["t"]), np.stack(pdf["ty"]), pdf["lo"].to_numpy(float), pdf["hi"].to_numpy(float)
            )
            for name, (kind, m, alpha) in specs.items():
                cheb, dropped = _ols_chebyshev(mo, m)
                if kind == "linear":
                    values = _times(mo.bases(_chebyshev_basis, m), cheb)
                else:
                    values = SOLVERS[kind](mo, m, alpha)
                    cheb = _times(mo.bases(_power_basis, m), values)
                each = lambda column: np.repeat(column, m + 1)
                yield pd.DataFrame(
                    {
                        "group": each(pdf["group"].to_numpy()),
                        "model": name,
                        "term": np.tile(np.arange(m + 1), len(pdf)),
                        "value": values.ravel(),
                        "cheb": cheb.ravel(),
                        "lo": each(mo.lo),
                        "hi": each(mo.hi),
                        "dropped": each(dropped),
                    }
                )

    return moments.mapInPandas(solve, f"group {group_type}, {FIT_SCHEMA}")


def fit_ols(df: DataFrame, x: str, y: str, m: int = 1, model: str = "linear") -> DataFrame:
    """Least-squares polynomial, as :func:`fit_many` gives it, without groups."""
    return fit_many(df, x, y, {model: ("linear", m, 0.0)}).drop("group")


def fit_ridge(df: DataFrame, x: str, y: str, m: int = 1, alpha: float = 1.0, model: str = "ridge") -> DataFrame:
    return fit_many(df, x, y, {model: ("ridge", m, alpha)}).drop("group")


def fit_lasso(df: DataFrame, x: str, y: str, m: int = 1, alpha: float = 0.1, model: str = "lasso") -> DataFrame:
    return fit_many(df, x, y, {model: ("lasso", m, alpha)}).drop("group")


def powers(coefs: DataFrame) -> DataFrame:
    """The coefficients of 1, x, ..., x^m alone: (group, if there are groups,) model, term, value."""
    return coefs.drop("cheb", "lo", "hi", "dropped")


def horner(coefs: Column, x: Column) -> Column:
    """Polynomial value from an array of coefficients, constant term first."""
    return F.aggregate(F.reverse(coefs), F.lit(0.0), lambda acc, c: acc * x + c)


def clenshaw(coefs: Column, u: Column) -> Column:
    """Sum of coefs[k] T_k(u) by Clenshaw's recurrence."""
    none = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("before"))
    step = lambda s, c: F.struct((F.lit(2.0) * u * s["now"] - s["before"] + c).alias("now"), s["now"].alias("before"))
    return F.aggregate(F.reverse(coefs), none, step, lambda s: s["now"] - u * s["before"])


def predict(
    df: DataFrame, coefs: DataFrame, x: str, name: str = "yhat", by: str | None = None
) -> DataFrame:
    """Fitted values of one model (or of one model per group, matched on ``group``).

    The coefficients of a model are a handful of numbers by construction. Fits are evaluated in their own Chebyshev basis; a table of (term, value) alone
    is taken as powers of x.
    """
    stable = {"cheb", "lo", "hi"} <= set(coefs.columns)
    arranged = F.transform(
        F.array_sort(F.collect_list(F.struct("term", F.col("cheb" if stable else "value").alias("value")))), lambda s: s["value"]
    )
    held, low, high, mapped = (fresh(k) for k in ("coefs", "lo", "hi", "unit"))
    needed = {held: arranged} | ({low: F.max("lo"), high: F.max("hi")} if stable else {})
    if by is None:
        with_coefs = attach_scalars(df, coefs, **needed)
    else:
        tables = coefs.groupBy(F.col("group").alias(by)).agg(*(c.alias(k) for k, c in needed.items()))
        with_coefs = join_on_keys(df, tables, [by], "left")
    at = F.col(quoted(x)).cast("double")
    if stable:
        lo, hi = F.col(low), F.col(high)
        wide = hi > lo
        unit = (F.lit(2.0) * at - lo - hi) / F.when(wide, hi - lo).otherwise(F.lit(1.0))
        # one different x: the basis is that of a range of 1 around it
        with_coefs = with_coefs.withColumn(mapped, F.when(wide, unit).otherwise(F.lit(2.0) * (at - lo)))
        return with_coefs.withColumn(name, clenshaw(F.col(held), F.col(mapped))).drop(*needed, mapped)
    return with_coefs.withColumn(name, horner(F.col(held), at)).drop(*needed)


def evaluate(df: DataFrame, y: ColumnLike, yhat: ColumnLike) -> DataFrame:
    """Mean squared error."""
    residual = as_col(y) - as_col(yhat)
    return df.agg(F.avg(residual * residual).alias("mse"))


# --- gradient descent -----------------------------------------------------------------

def linear_moments(df: DataFrame, features: Sequence[str], y: str) -> tuple[int, np.ndarray, np.ndarray, float]:
    """n, X'X, X'y and y'y with a leading column of ones, in one aggregation."""
    cols = [F.lit(1.0), *[F.col(quoted(f)).cast("double") for f in features]]
    target = F.col(quoted(y)).cast("double")
    k = len(cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = (
        df.dropna(subset=[quoted(c) for c in [*features, y]])
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(cols[i] * cols[j]) for i, j in pairs]).alias("xx"),
            F.array(*[F.sum(c * target) for c in cols]).alias("xy"),
            F.sum(target * target).alias("yy"),
        )
        .first()
    )
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, row["xx"]):
        gram[i, j] = gram[j, i] = v
    return row["n"], gram, np.array(row["xy"]), row["yy"]


def fit_gradient(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    schedule: Mapping,
    steps: int,
    l2: float = 0.0,
    init: Sequence[float] | None = None,
    reduction: str = "mean",
    model: str = "gradient",
) -> tuple[DataFrame, DataFrame]:
    """Gradient descent on the squared error; returns coefficients and loss history.

    The gradient depends on the data only through moments, so one pass over the table
    serves all steps. ``reduction="sum"`` uses the gradient of the summed error.
    """
    n, gram, xy, yy = linear_moments(df, features, y)
    w = np.zeros(len(xy)) if init is None else np.asarray(init, dtype=float).copy()
    weight = 1.0 / n if reduction == "mean" else 1.0
    free = np.r_[0.0, np.ones(len(w) - 1)]
    losses = []
    for step in range(steps):
        gw = gram @ w
        losses.append((model, step, float((w @ gw - 2 * w @ xy + yy) / n + l2 * (free * w) @ w)))
        w = w - rate_at(step, schedule) * (2 * weight * (gw - xy) + 2 * l2 * free * w)
    spark = df.sparkSession
    return (
        spark.createDataFrame(_coef_rows(model, w), COEF_SCHEMA),
        spark.createDataFrame(losses, "model string, step int, loss double"),
    )


def early_stop(
    history: DataFrame, step: str = "step", loss: str = "loss", patience: int = 5, by: Sequence[str] = ("model",)
) -> DataFrame:
    """Best step and the step at which training stops, per run.

    A step is a gain when its loss is below all before; the run stops at the first step that
    lies ``patience`` steps after the latest gain. A run is as long as its training.
    """
    order = Window.partitionBy(*by).orderBy(step)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col(loss) < F.coalesce(F.min(loss).over(before), F.lit(float("inf")))
    traced = history.withColumn("_gain", F.when(gain, F.col(step)))
    traced = traced.withColumn("_gain", F.max("_gain").over(upto))
    waited = F.col(step) - F.col("_gain") >= patience
    traced = traced.withColumn("_stopped", F.coalesce(F.max(waited).over(before), F.lit(False)))
    return (
        traced.where(~F.col("_stopped"))
        .groupBy(*by)
        .agg(
            F.max("_gain").alias("best_step"),
            F.min(loss).alias("best_loss"),
            F.max(step).alias("stop_step"),
        )
    )


# --- maximum likelihood ---------------------------------------------------------------

def fit_gaussian(df: DataFrame, features: Sequence[str], y: str, model: str = "gaussian") -> DataFrame:
    """Normal model with linear mean and constant variance, by maximum likelihood.

    Terms 0.. are the mean's coefficients, term -1 is sigma and term -2 the log likelihood.
    """
    n, gram, xy, yy = linear_moments(df, features, y)
    size = np.sqrt(np.diag(gram))
    size[size == 0] = 1.0
    w = np.linalg.lstsq(gram / np.outer(size, size), xy / size, rcond=None)[0] / size
    sigma = float(np.sqrt(max((w @ gram @ w - 2 * w @ xy + yy) / n, 0.0)))
    likelihood = -n * (0.5 * LOG_2PI + np.log(sigma) + 0.5) if sigma > 0 else float("inf")
    rows = [*_coef_rows(model, w), (model, -1, sigma), (model, -2, float(likelihood))]
    return df.sparkSession.createDataFrame(rows, COEF_SCHEMA)


def linear_column(features: Sequence[str], w: Sequence[float]) -> Column:
    """w0 + w1 f1 + ... as a column expression."""
    out = F.lit(float(w[0]))
    for f, c in zip(features, w[1:]):
        out = out + F.lit(float(c)) * F.col(quoted(f))
    return out


def fit_hetero(
    df: DataFrame,
    mean_features: Sequence[str],
    sigma_features: Sequence[str],
    y: str,
    steps: int = 10,
    model: str = "hetero",
) -> tuple[DataFrame, DataFrame]:
    """Normal model with linear mean and linear log sigma; returns coefficients and NLL history.

    Each step is one aggregation: at the present sigma it gives the weighted normal equations
    of the mean, and the gradient and expected Hessian (Fisher scoring) of log sigma at the
    present mean. Coefficient rows are named ``<model>_mean`` and ``<model>_log_sigma``.
    """
    data = df.select(
        *[F.col(quoted(c)).cast("double").alias(c) for c in dict.fromkeys([*mean_features, *sigma_features, y])]
    ).dropna()
    data = data.persist()
    try:
        start = fit_gaussian(data, mean_features, y).collect()
        beta = np.array([r["value"] for r in sorted(start, key=lambda r: r["term"]) if r["term"] >= 0])
        gamma = np.zeros(len(sigma_features) + 1)
        gamma[0] = np.log(max(next(r["value"] for r in start if r["term"] == -1), 1e-12))
        xs = [F.lit(1.0), *[F.col(quoted(f)) for f in mean_features]]
        zs = [F.lit(1.0), *[F.col(quoted(f)) for f in sigma_features]]
        xp = [(i, j) for i in range(len(xs)) for j in range(i, len(xs))]
        zp = [(i, j) for i in range(len(zs)) for j in range(i, len(zs))]

        def symmetric(pairs, values, k):
            out = np.zeros((k, k))
            for (i, j), v in zip(pairs, values):
                out[i, j] = out[j, i] = v
            return out

        losses, best = [], (np.inf, beta, gamma)
        shrink, proposal = 1.0, (beta, gamma)
        for step in range(steps):
            beta, gamma = proposal
            target = F.col(quoted(y))
            staged = data.withColumns(
                {"_ls": linear_column(sigma_features, gamma), "_r": target - linear_column(mean_features, beta)}
            ).withColumn("_w", F.exp(F.lit(-2.0) * F.col("_ls")))
            w, r, ls = F.col("_w"), F.col("_r"), F.col("_ls")
            row = staged.agg(
                F.count("*").alias("n"),
                F.sum(ls + F.lit(0.5) * r * r * w + F.lit(0.5 * LOG_2PI)).alias("nll"),
                F.array(*[F.sum(w * xs[i] * xs[j]) for i, j in xp]).alias("xx"),
                F.array(*[F.sum(w * x * target) for x in xs]).alias("xy"),
                F.array(*[F.sum(z * (r * r * w - 1.0)) for z in zs]).alias("g"),
                F.array(*[F.sum(zs[i] * zs[j]) for i, j in zp]).alias("h"),
            ).first()
            nll = row["nll"] / row["n"]
            losses.append((model, step, float(nll)))
            if nll <= best[0]:
                best, shrink = (nll, beta, gamma), 1.0
                new_beta = np.linalg.lstsq(symmetric(xp, row["xx"], len(xs)), np.array(row["xy"]), rcond=None)[0]
                move = np.linalg.lstsq(2 * symmetric(zp, row["h"], len(zs)), np.array(row["g"]), rcond=None)[0]
                direction = (new_beta - beta, move)
            else:
                shrink /= 2  # the step went too far: try half of it from the best point
            proposal = (best[1] + shrink * direction[0], best[2] + shrink * direction[1])
    finally:
        data.unpersist()
    _, beta, gamma = best
    rows = [*_coef_rows(f"{model}_mean", beta), *_coef_rows(f"{model}_log_sigma", gamma)]
    spark = df.sparkSession
    return (
        spark.createDataFrame(rows, COEF_SCHEMA),
        spark.createDataFrame(losses, "model string, step int, loss double"),
    )


def sigma_band(df: DataFrame, mu: str, sigma: ColumnLike, k: float = 2.0) -> DataFrame:
    """Band mu - k sigma .. mu + k sigma as columns ``lower`` and ``upper``."""
    reach = F.lit(float(k)) * as_col(sigma)
    return df.withColumns({"lower": F.col(mu) - reach, "upper": F.col(mu) + reach})


def averaged_sigma_band(df: DataFrame, by: Sequence[str], mu: str, log_sigma: str, k: float = 2.0) -> DataFrame:
    """Mean of mu per grid point with one band width: sigma averaged over all points and runs."""
    means = df.groupBy(*by).agg(F.avg(mu).alias(mu))
    wide = attach_scalars(means, df, _sigma=F.avg(F.exp(log_sigma)))
    return sigma_band(wide, mu, "_sigma", k).drop("_sigma")
