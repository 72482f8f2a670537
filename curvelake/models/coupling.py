"""Two-dimensional affine coupling maps with given small nets (Dinh et al. 2017)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.likelihood import diagonal_normal_log_prob
from ..functions.scalars import quadrant, quoted
from .nets import Net, forward, through_arrays


@dataclass
class Coupling:
    """``mask`` has 1 for the coordinate that passes through and feeds the nets.

    ``scale_net`` ends in tanh, ``shift_net`` in a linear layer; both map 2 to 2 values.
    """

    mask: tuple[int, int]
    scale_net: Net
    shift_net: Net


def to_latent_step(points: np.ndarray, layer: Coupling) -> tuple[np.ndarray, np.ndarray]:
    """One layer from data to latent space, with its log determinant."""
    m = np.asarray(layer.mask, dtype=float)
    s = forward(layer.scale_net, points * m)[-1] * (1 - m)
    t = forward(layer.shift_net, points * m)[-1] * (1 - m)
    return (1 - m) * (points - t) * np.exp(-s) + m * points, -s.sum(axis=1)


def to_data_step(points: np.ndarray, layer: Coupling) -> np.ndarray:
    """One layer from latent to data space."""
    m = np.asarray(layer.mask, dtype=float)
    s = forward(layer.scale_net, points * m)[-1] * (1 - m)
    t = forward(layer.shift_net, points * m)[-1] * (1 - m)
    return (1 - m) * (points * np.exp(s) + t) + m * points


def coupling_inverse(
    df: DataFrame, x1: str, x2: str, layers: Sequence[Coupling], out: tuple[str, str, str] = ("z1", "z2", "log_det")
) -> DataFrame:
    """Data to latent space, last layer first, with the log determinant of the whole map."""

    def run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        points, det = np.stack([a, b], axis=1).astype(float), np.zeros(len(a))
        for layer in reversed(layers):
            points, part = to_latent_step(points, layer)
            det += part
        return np.column_stack([points, det])

    return through_arrays(df, [x1, x2], run, out)


def coupling_forward(
    df: DataFrame, z1: str, z2: str, layers: Sequence[Coupling], out: tuple[str, str] = ("x1", "x2")
) -> DataFrame:
    """Latent to data space, first layer first."""

    def run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        points = np.stack([a, b], axis=1).astype(float)
        for layer in layers:
            points = to_data_step(points, layer)
        return points

    return through_arrays(df, [z1, z2], run, out)


def coupling_loss(df: DataFrame, x1: str, x2: str, layers: Sequence[Coupling]) -> DataFrame:
    """Mean negative log density of the data under the map."""
    mapped = coupling_inverse(df.select(x1, x2), x1, x2, layers)
    log_prob = diagonal_normal_log_prob(["z1", "z2"], [0.0, 0.0], [1.0, 1.0])
    return mapped.agg((-F.avg(log_prob + F.col("log_det"))).alias("loss"))


def layer_trace(df: DataFrame, key: str, z1: str, z2: str, layers: Sequence[Coupling]) -> DataFrame:
    """Coordinates after 0, 1, ... layers on the way to data space, one row per point and
    layer, with the quadrant of the starting point."""
    start = df.select(key, z1, z2, quadrant(z1, z2).alias("start_quadrant"))

    def run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        points = np.stack([a, b], axis=1).astype(float)
        steps = [points]
        for layer in layers:
            points = to_data_step(points, layer)
            steps.append(points)
        return np.concatenate(steps, axis=1)

    places = range(len(layers) + 1)
    wide = through_arrays(start, [z1, z2], run, [f"_{c}{i}" for i in places for c in ("a", "b")])
    steps = [F.struct(F.lit(i).alias("layer"), F.col(f"_a{i}").alias("x1"), F.col(f"_b{i}").alias("x2")) for i in places]
    return wide.select(quoted(key), "start_quadrant", F.inline(F.array(*steps)))
