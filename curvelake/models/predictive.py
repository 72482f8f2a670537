"""Predictive draws on a grid and their summaries.

Draws are functions of (run, grid point, unit, seed), so any task can make its own share.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.scalars import as_col, quoted
from ..operators.joins import repeat_runs
from .nets import ACTIVATIONS, Layer, through_arrays


def predictive_draws(
    grid: DataFrame, key: str, mu: str, sigma: str, runs: int, seed: int = 0, name: str = "y_draw"
) -> DataFrame:
    """One draw from N(mu, sigma) per grid row and run."""
    spread = repeat_runs(grid, runs)
    return spread.withColumn(
        name, F.col(mu) + F.col(sigma) * draws.normal(draws.whole(grid, key), F.col("run"), seed=seed)
    )


def draw_summary(
    draws_table: DataFrame, by: Sequence[str], value: str = "y_draw", lo: float = 0.025, hi: float = 0.975
) -> DataFrame:
    """Mean and two quantiles per grid point. A group holds as many rows as there are runs."""
    quantiles = F.percentile(F.col(quoted(value)), F.array(F.lit(float(lo)), F.lit(float(hi))))
    return (
        draws_table.groupBy(*by)
        .agg(F.avg(value).alias("mean"), quantiles.alias("_q"))
        .select(*by, "mean", F.col("_q")[0].alias("lower"), F.col("_q")[1].alias("upper"))
    )


def weight_draws(
    grid: DataFrame,
    features: Sequence[str],
    weight_means: Sequence[float],
    weight_sds: Sequence[float],
    runs: int,
    seed: int = 0,
    name: str = "y_draw",
) -> DataFrame:
    """Predictions with random weights: in every run one normal draw per weight (constant
    first), the same for all grid points."""
    if not len(features) + 1 == len(weight_means) == len(weight_sds):
        raise ValueError("one mean and one sd per feature, after those of the constant")
    terms = [F.lit(1.0), *[as_col(f) for f in features]]
    total = F.lit(0.0)
    for i, (term, mean, sd) in enumerate(zip(terms, weight_means, weight_sds)):
        weight = F.lit(float(mean)) + F.lit(float(sd)) * draws.normal("run", F.lit(i), seed=seed)
        total = total + weight * term
    return repeat_runs(grid, runs).withColumn(name, total)


def unit_mask(keys: np.ndarray | tuple[np.ndarray, ...], units: int, layer: int, rate: float, seed: int) -> np.ndarray:
    """Kept units of a layer per key (or combination of keys), scaled by 1 / (1 - rate)."""
    keys = keys if isinstance(keys, tuple) else (keys,)
    u = draws.uniform_array(*(np.asarray(k)[:, None] for k in keys), layer, np.arange(units)[None, :], seed=seed)
    return (u >= rate) / (1.0 - rate)


def dropout_draws(
    grid: DataFrame,
    key: str,
    x: Sequence[str],
    layers: Sequence[Layer],
    rate: float,
    runs: int,
    seed: int = 0,
    outputs: Sequence[str] = ("mu", "log_sigma"),
) -> DataFrame:
    """Outputs of a given small net with hidden units dropped at scoring time.

    Units drop independently per grid row and run; kept units are scaled by 1 / (1 - rate).
    """
    spread = repeat_runs(grid, runs)
    fixed = list(layers)

    def score(keys: np.ndarray, run: np.ndarray, *columns: np.ndarray) -> np.ndarray:
        values = np.stack(columns, axis=1).astype(float)
        for i, layer in enumerate(fixed):
            values = ACTIVATIONS[layer.act][0](values @ layer.weights + layer.bias)
            if i < len(fixed) - 1:
                values = values * unit_mask((keys, run), values.shape[1], i, rate, seed)
        return values

    inputs = [draws.whole(grid, key), F.col("run"), *(F.col(quoted(c)).cast("double") for c in x)]
    return through_arrays(spread, inputs, score, outputs)
