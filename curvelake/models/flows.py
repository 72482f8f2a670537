"""One-dimensional density models from a chain of invertible maps.

A block maps z to scale * sinh((asinh z + skew) * tail) + shift (sinh-arcsinh transform of
Jones and Pewsey 2009). In a chain the last listed block acts first on z. Every step of a
chain is its own projection, so no value is computed twice.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.likelihood import LOG_2PI, rate_at
from ..functions.scalars import ColumnLike, as_col, asinh, log_cosh, quoted
from ..operators.joins import fresh
from ..sources.generators import linspace
from .blocks import Arrays, blocks as in_blocks, summed


@dataclass(frozen=True)
class Block:
    shift: float = 0.0
    scale: float = 1.0
    skew: float = 0.0
    tail: float = 1.0


Chain = Sequence[Block]


def sinh_arcsinh(z: ColumnLike, skew: float = 0.0, tail: float = 1.0) -> Column:
    """sinh((asinh z + skew) * tail); the identity at skew 0 and tail 1."""
    return F.sinh((asinh(as_col(z)) + F.lit(float(skew))) * F.lit(float(tail)))


def flow_forward(df: DataFrame, z: str, chain: Chain, name: str = "x") -> DataFrame:
    """Base value to data value."""
    at = fresh("z")
    out = df.withColumn(at, F.col(quoted(z)).cast("double"))
    for b in reversed(chain):
        bent = sinh_arcsinh(at, b.skew, b.tail)
        out = out.withColumn(at, bent * F.lit(float(b.scale)) + F.lit(float(b.shift)))
    return out.withColumn(name, F.col(at)).drop(at)


def flow_inverse(
    df: DataFrame, x: str, chain: Chain, name: str = "z", log_det: str | None = None
) -> DataFrame:
    """Data value to base value, on request with ln |dz/dx|."""
    at, u, bent, det = fresh("v"), fresh("u"), fresh("t"), fresh("det")
    out = df.withColumns({at: F.col(quoted(x)).cast("double"), det: F.lit(0.0)})
    for b in chain:
        out = out.withColumn(u, (F.col(at) - F.lit(float(b.shift))) / F.lit(float(b.scale)))
        out = out.withColumn(bent, asinh(u) / F.lit(float(b.tail)) - F.lit(float(b.skew)))
        if log_det:
            constant = -math.log(abs(b.scale)) - math.log(abs(b.tail))
            slope = log_cosh(bent) - F.lit(0.5) * F.log1p(F.col(u) * F.col(u))
            out = out.withColumn(det, F.col(det) + F.lit(constant) + slope)
        out = out.withColumn(at, F.sinh(bent))
    out = out.withColumn(name, F.col(at))
    if log_det:
        out = out.withColumn(log_det, F.col(det))
    return out.drop(at, u, bent, det)


def flow_log_prob(df: DataFrame, x: str, chain: Chain, name: str = "log_prob") -> DataFrame:
    """Log density of the data value under the chain with a standard normal base."""
    z, det = fresh("z"), fresh("det")
    normal = F.lit(-0.5 * LOG_2PI) - F.lit(0.5) * F.col(z) * F.col(z)
    return flow_inverse(df, x, chain, z, det).withColumn(name, normal + F.col(det)).drop(z, det)


def flow_prob(df: DataFrame, x: str, chain: Chain, name: str = "prob") -> DataFrame:
    log_prob = fresh("lp")
    return flow_log_prob(df, x, chain, log_prob).withColumn(name, F.exp(log_prob)).drop(log_prob)


def flow_nll(df: DataFrame, x: str, chain: Chain) -> DataFrame:
    """Mean negative log density."""
    return flow_log_prob(df, x, chain, "_lp").agg((-F.avg("_lp")).alias("nll"))


def roundtrip_error(df: DataFrame, x: str, chain: Chain) -> DataFrame:
    """Sum and largest size of x - f(f^-1(x)); both 0 up to rounding."""
    back = flow_forward(flow_inverse(df, x, chain, "_z"), "_z", chain, "_back")
    error = F.col(quoted(x)) - F.col("_back")
    return back.agg(F.sum(error).alias("sum_error"), F.max(F.abs(error)).alias("max_error"))


def flow_sample_over(df: DataFrame, key: str, chain: Chain, seed: int = 0, name: str = "x") -> DataFrame:
    """One draw from the density per key."""
    return flow_forward(df.select(key, draws.normal(draws.whole(df, key), seed=seed).alias("_z")), "_z", chain, name).drop("_z")


def flow_sample(spark: SparkSession, chain: Chain, n: int, seed: int = 0) -> DataFrame:
    return flow_sample_over(spark.range(n), "id", chain, seed)


def flow_curve(spark: SparkSession, chain: Chain, lo: float, hi: float, n: int) -> DataFrame:
    """Density at x and map at z on one grid."""
    grid = linspace(spark, lo, hi, n, "x")
    return flow_forward(flow_prob(grid, "x", chain), "x", chain, "mapped")


def swap_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    """Exchange two coordinates."""
    return df.withColumns({a: F.col(quoted(b)), b: F.col(quoted(a))})


def latent_path(df: DataFrame, x_from: str, x_to: str, chain: Chain, k: int) -> DataFrame:
    """k points between two data values: along a straight line in base space and in data space."""
    ends = flow_inverse(flow_inverse(df, x_from, chain, "_a"), x_to, chain, "_b")
    steps = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i.cast("double") / F.lit(float(max(k - 1, 1))))
    m = F.col("m")
    path = ends.select("*", F.posexplode(steps).alias("step", "m")).withColumns(
        {
            "_z": m * F.col("_b") + (1 - m) * F.col("_a"),
            "straight": m * F.col(quoted(x_to)) + (1 - m) * F.col(quoted(x_from)),
        }
    )
    return flow_forward(path, "_z", chain, "curved").drop("_a", "_b", "_z")


# --- fitting --------------------------------------------------------------------------

#: Rows of the fits' histories.
HISTORY = "model string, step int, loss double"
CONVERGED = f"{HISTORY}, gradient double, passes int, stopped string"


def _block_sums(x: np.ndarray, params: np.ndarray) -> np.ndarray:
    """Rows, then sums of the log density and its slopes that :func:`_slopes` makes means of; the chain rule forward through the blocks and back."""
    log_p, v, trace = np.zeros(len(x)), x, []
    for shift, scale, skew, tail in params:
        u = (v - shift) / scale
        root = np.sqrt(1.0 + u * u)
        a = np.copysign(np.log(np.abs(u) + root), u)
        t = a / tail - skew
        size = np.abs(t)
        low = np.exp(-size)
        high, square = 1.0 / low, low * low
        v = np.copysign(0.5 * (high - low), t)
        log_p += size + np.log1p(square) - math.log(2.0) - np.log(root)
        trace.append((u, a, root, 0.5 * (high + low), np.copysign((1.0 - square) / (1.0 + square), t)))
    sums, down = [], -v
    for (_, scale, _, tail), (u, a, root, cosh, tanh) in zip(params[::-1], trace[::-1]):
        d = down * cosh + tanh
        w = (d / tail - u / root) / root
        sums.append([w.sum(), (w * u).sum(), d.sum(), (d * a).sum()])
        down = w / scale
    return np.concatenate([[len(x), (log_p - 0.5 * v * v).sum()], *sums[::-1]])


def _slopes(table: DataFrame, params: np.ndarray) -> np.ndarray:
    """Mean log density and its slopes from the blocks of the values; NaN without rows."""

    def sums(block: Arrays) -> np.ndarray:
        with np.errstate(all="ignore"):  # a step too far gives values that are not finite
            return _block_sums(block["_x"], params)

    total = summed(table, {"_x": float}, sums)
    means = total[1:] / total[0] if len(total) else np.full(1 + params.size, np.nan)
    _, scale, _, tail = params.T
    mean = means[0] - 0.5 * LOG_2PI - np.log(np.abs(scale)).sum() - np.log(np.abs(tail)).sum()
    slope = means[1:].reshape(params.shape)
    by_block = np.column_stack([-slope[:, 0] / scale, -(slope[:, 1] + 1) / scale, -slope[:, 2], -slope[:, 3] / tail**2 - 1 / tail])
    return np.concatenate([[mean], by_block.ravel()])


def flow_slopes(data: DataFrame, x: str, params: np.ndarray) -> np.ndarray:
    """Mean log density and its slopes by (shift, scale, skew, tail) of each block, in one aggregation over ``data``."""
    return _slopes(in_blocks(_values(data, x)), params)


def _values(df: DataFrame, x: str) -> DataFrame:
    return df.select(F.col(quoted(x)).cast("double").alias("_x")).dropna()


def fit_flow(
    df: DataFrame,
    x: str,
    blocks: int = 5,
    schedule: Mapping | None = None,
    steps: int = 100,
    start: Chain | None = None,
    model: str = "flow",
) -> tuple[list[Block], DataFrame]:
    """A fixed number of gradient steps on the mean negative log density; returns the chain and the loss before each step.

    Every step is one aggregation of 1 + 4 * blocks numbers. Scale the data to about unit size first. :func:`fit_flow_converged`
    needs far fewer passes and says when it is done.
    """
    schedule = schedule or {"kind": "constant", "rate": 0.01}
    params = np.array([astuple(b) for b in (start or [Block()] * blocks)], dtype=float)
    data, history = in_blocks(_values(df, x)).persist(), []
    try:
        for step in range(steps):
            total = _slopes(data, params)
            history.append((model, step, float(-total[0])))
            params = params + rate_at(step, schedule) * total[1:].reshape(params.shape)
    finally:
        data.unpersist()
    chain = [Block(*map(float, p)) for p in params]
    return chain, df.sparkSession.createDataFrame(history, HISTORY)


def fit_flow_converged(
    df: DataFrame,
    x: str,
    blocks: int = 5,
    tolerance: float = 1e-4,
    passes: int = 300,
    patience: int | None = None,
    min_delta: float = 0.0,
    start: Chain | None = None,
    model: str = "flow",
) -> tuple[list[Block], DataFrame]:
    """Least mean negative log density by a quasi-Newton method (BFGS); returns the chain and a history.

    A pass over the table gives the loss and all slopes at once; steps are searched until they lower the loss enough and the slope along
    them has turned (weak Wolfe conditions). It stops when no slope of the mean loss, by (shift, ln scale, skew, ln tail) of any block, is above
    ``tolerance``, or when the loss has fallen by less than ``min_delta`` over ``patience`` points (a chain can have no best point: where the
    density has an edge, more blocks sharpen it for ever). The history has a row per accepted point: loss, the largest slope, passes so far, and on the last row why it
    stopped: ``gradient``, ``patience``, ``passes`` or ``no descent``. Rows with null are left out; a table without values has a null loss and stops
    with ``no rows``. Scale the data to about unit size first.
    """
    first = np.array([astuple(b) for b in (start or [Block()] * blocks)], dtype=float)
    at = np.column_stack([first[:, 0], np.log(first[:, 1]), first[:, 2], np.log(first[:, 3])]).ravel()
    used = 0
    data, history = in_blocks(_values(df, x)).persist(), []

    def block_params(flat: np.ndarray) -> np.ndarray:
        shift, scale, skew, tail = flat.reshape(-1, 4).T
        return np.column_stack([shift, np.exp(scale), skew, np.exp(tail)])

    def look(flat: np.ndarray) -> tuple[float, np.ndarray]:
        nonlocal used
        used += 1
        params = block_params(flat)
        total = _slopes(data, params)
        slope = -total[1:].reshape(params.shape) * np.column_stack([np.ones(len(params)), params[:, 1], np.ones(len(params)), params[:, 3]])
        return (float(-total[0]), slope.ravel()) if np.isfinite(total).all() else (math.inf, slope.ravel())

    try:
        loss, slope = look(at)
        hessian, scaled, why = np.eye(len(at)), False, None
        if not math.isfinite(loss):
            history.append((model, 0, None, None, used, "no rows" if data.isEmpty() else "no descent"))
        while math.isfinite(loss) and why is None:
            size = float(np.abs(slope).max())
            waited = patience is not None and len(history) >= patience and history[-patience][2] - loss < min_delta
            why = "gradient" if size <= tolerance else "patience" if waited else "passes" if used >= passes else None
            history.append((model, len(history), loss, size, used, why))
            if why:
                break
            way = -hessian @ slope
            if way @ slope >= 0:
                hessian, way = np.eye(len(at)), -slope
            step, low, high = (1.0 if scaled else min(1.0, 0.2 / size)), 0.0, math.inf
            found = None
            while used < passes:
                new = at + step * way
                new_loss, new_slope = look(new)
                if new_loss > loss + 1e-4 * step * (way @ slope):
                    high = step
                elif new_slope @ way < 0.9 * (way @ slope):
                    low, found = step, (new, new_loss, new_slope)
                else:
                    found = (new, new_loss, new_slope)
                    break
                step = (low + high) / 2 if math.isfinite(high) else 2 * low
                if math.isfinite(high) and high - low < 1e-10 * max(1.0, high):
                    break
            if found is None:
                if used < passes and (hessian != np.eye(len(at))).any():
                    hessian, scaled = np.eye(len(at)), False
                    history.pop()
                    continue
                history[-1] = (*history[-1][:5], "passes" if used >= passes else "no descent")
                break
            moved, turned = found[0] - at, found[2] - slope
            at, loss, slope = found
            bend = moved @ turned
            if bend > 1e-12:
                if not scaled:
                    hessian, scaled = np.eye(len(at)) * (bend / (turned @ turned)), True
                keep = np.eye(len(at)) - np.outer(moved, turned) / bend
                hessian = keep @ hessian @ keep.T + np.outer(moved, moved) / bend
    finally:
        data.unpersist()
    chain = [Block(*map(float, p)) for p in block_params(at)]
    return chain, df.sparkSession.createDataFrame(history, CONVERGED)
