"""Training of small dense nets, with the rows spread over the cluster.

The rows are packed into blocks of arrays once. Each step sends the present weights to the tasks; a task adds up the gradient of its own
rows and the loss of those held out, Spark adds the tasks' sums, and the driver moves the weights. What comes to
the driver has the size of the net.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.draws import uniform_array, whole
from ..functions.likelihood import LOG_2PI, rate_at
from ..functions.scalars import quoted
from .blocks import Arrays, blocks as in_blocks, summed

# Function and derivative (the latter from the function's value).
ACTIVATIONS = {
    "linear": (lambda v: v, lambda a: np.ones_like(a)),
    "tanh": (np.tanh, lambda a: 1 - a * a),
    "sigmoid": (lambda v: 1 / (1 + np.exp(-np.clip(v, -500, 500))), lambda a: a * (1 - a)),
    "relu": (lambda v: np.maximum(v, 0.0), lambda a: (a > 0).astype(float)),
}


@dataclass
class Layer:
    weights: np.ndarray
    bias: np.ndarray
    act: str = "tanh"


Net = Sequence[Layer]


def new_net(inputs: int, units: Sequence[int], acts: Sequence[str], seed: int = 0) -> list[Layer]:
    """Random uniform start (Glorot and Bengio 2010), zero biases."""
    rng = np.random.default_rng(seed)
    net, before = [], inputs
    for n, act in zip(units, acts):
        limit = np.sqrt(6.0 / (before + n))
        net.append(Layer(rng.uniform(-limit, limit, (before, n)), np.zeros(n), act))
        before = n
    return net


def forward(net: Net, x: np.ndarray) -> list[np.ndarray]:
    values = [x]
    for layer in net:
        values.append(ACTIVATIONS[layer.act][0](values[-1] @ layer.weights + layer.bias))
    return values


def backward(net: Net, values: list[np.ndarray], slope: np.ndarray) -> np.ndarray:
    """Gradient of a summed loss by all weights, from its slope at the outputs."""
    parts = []
    for layer, before, after in zip(reversed(net), reversed(values[:-1]), reversed(values[1:])):
        at_sum = slope * ACTIVATIONS[layer.act][1](after)
        parts += [at_sum.sum(axis=0), (before.T @ at_sum).ravel()]
        slope = at_sum @ layer.weights.T
    return np.concatenate(parts[::-1])


def pack(net: Net) -> np.ndarray:
    return np.concatenate([p for layer in net for p in (layer.weights.ravel(), layer.bias)])


def unpack(net: Net, flat: np.ndarray) -> list[Layer]:
    out, at = [], 0
    for layer in net:
        w, b = layer.weights.size, layer.bias.size
        out.append(Layer(flat[at : at + w].reshape(layer.weights.shape), flat[at + w : at + w + b], layer.act))
        at += w + b
    return out


def mse_loss(out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed squared error of the first output, with its slope."""
    slope = np.zeros_like(out)
    residual = out[:, 0] - y
    slope[:, 0] = 2 * residual
    return float(residual @ residual), slope


def hetero_loss(out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed -ln N(y; first output, e^second output), with its slope."""
    weight = np.exp(-2 * out[:, 1])
    residual = out[:, 0] - y
    square = residual * residual * weight
    slope = np.column_stack([residual * weight, 1 - square])
    return float(np.sum(out[:, 1] + square / 2 + LOG_2PI / 2)), slope


LOSSES = {"mse": mse_loss, "hetero": hetero_loss}


def _prepare(df: DataFrame, x: Sequence[str], y: str, key: str | None, held: bool) -> DataFrame:
    """Inputs, target, whether the row is held out, and its key, if one is named; rows without an input or the target are left out."""
    numbers = [F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(x)]
    keyed = [whole(df, key).alias("key")] if key else []
    rows = df.select(*numbers, F.col(quoted(y)).cast("double").alias("y"), F.lit(held).alias("held"), *keyed)
    return rows.dropna(subset=[*(f"x{i}" for i in range(len(x))), "y"])


@dataclass(frozen=True)
class Stopping:
    """Training ends when the watched loss, of the held-out rows if there are any, has not fallen by ``min_delta`` for ``patience`` steps."""

    patience: int
    min_delta: float = 0.0


@dataclass(frozen=True)
class Batches:
    """Each step takes the share of the rows that the hash of their key and the step picks: the same rows wherever they lie."""

    key: str
    share: float
    seed: int = 0


def fit_net(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    net: Net,
    loss: str = "mse",
    schedule: Mapping | None = None,
    steps: int = 100,
    l2: float = 0.0,
    validation: DataFrame | None = None,
    model: str = "net",
    stopping: Stopping | None = None,
    batches: Batches | None = None,
) -> tuple[list[Layer], DataFrame]:
    """Gradient descent over all rows, or over keyed batches; returns the trained net and (model, step, loss, val_loss, stopped).

    A step is one job: gradient and held-out loss come from the same pass. With ``stopping`` the weights returned are those of the
    least watched loss, and the last row says why training ended: ``patience`` or ``steps``.
    """
    schedule = schedule or {"kind": "constant", "rate": 0.01}
    blocks = [(net, schedule, 0)]
    return _train(
        df, x, y, blocks, LOSSES[loss], steps, l2, validation, model, lambda outs: outs[0], lambda nets: nets[0], stopping, batches
    )


def fit_two_heads(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    mean_net: Net,
    sigma_net: Net,
    mean_schedule: Mapping,
    sigma_schedule: Mapping,
    steps: int = 100,
    mean_start: int = 0,
    sigma_start: int = 0,
    l2: float = 0.0,
    validation: DataFrame | None = None,
    model: str = "two_heads",
    stopping: Stopping | None = None,
    batches: Batches | None = None,
) -> tuple[tuple[list[Layer], list[Layer]], DataFrame]:
    """Separate nets for mean and log sigma under one likelihood, each with its own learning
    rate and its own first step; before that step its weights stay as they are. The rest is as in :func:`fit_net`."""
    blocks = [(mean_net, mean_schedule, mean_start), (sigma_net, sigma_schedule, sigma_start)]
    return _train(df, x, y, blocks, hetero_loss, steps, l2, validation, model, np.hstack, tuple, stopping, batches)


def _train(df, x, y, blocks, loss_fn, steps, l2, validation, model, merge, join, stopping, batches):
    nets = [n for n, _, _ in blocks]
    flats = [pack(n) for n in nets]
    key = batches.key if batches else None
    data = _prepare(df, x, y, key, False)
    if validation is not None:
        data = data.unionByName(_prepare(validation, x, y, key, True))
    data = in_blocks(data).persist()
    kinds = {**{f"x{i}": float for i in range(len(x))}, "y": float, "held": bool, **({"key": np.int64} if batches else {})}
    decay = [np.concatenate([np.r_[np.ones(la.weights.size), np.zeros(la.bias.size)] for la in net]) for net in nets]
    history, best, waited, why = [], (np.inf, flats), 0, "steps"
    try:
        for step in range(steps):
            now = [unpack(net, flat) for net, flat in zip(nets, flats)]

            def sums(block: Arrays, now=now, step=step):
                """Held-out rows and their loss, then rows in training, their loss and its slopes."""
                xs, ys, held = np.column_stack([block[f"x{i}"] for i in range(len(x))]), block["y"], block["held"]
                value = loss_fn(merge([forward(net, xs[held])[-1] for net in now]), ys[held])[0]
                taken = ~held
                if batches:
                    taken &= uniform_array(block["key"], np.int64(step), seed=batches.seed) < batches.share
                xs, ys = xs[taken], ys[taken]
                traces = [forward(net, xs) for net in now]
                outs = [t[-1] for t in traces]
                loss, slope = loss_fn(merge(outs), ys)
                parts, at = [], 0
                for net, trace, out in zip(now, traces, outs):
                    parts.append(backward(net, trace, slope[:, at : at + out.shape[1]]))
                    at += out.shape[1]
                return np.concatenate([[held.sum(), value, len(ys), loss], *parts])

            total = summed(data, kinds, sums)
            n_held, held_loss, n = total[:3] if len(total) else (0, 0.0, 0)
            val_loss = float(held_loss / n_held) if n_held else None
            if not n:  # nothing to learn from in this batch, or at all
                history.append((model, step, None, val_loss, None))
                if not batches:
                    why = "no rows"
                    break
                continue
            penalty = l2 * sum(float((d * f) @ f) for d, f in zip(decay, flats))
            loss = float(total[3] / n + penalty)
            history.append((model, step, loss, val_loss, None))
            if stopping:
                watched = loss if val_loss is None else val_loss
                if watched < best[0] - stopping.min_delta:
                    best, waited = (watched, flats), 0
                else:
                    waited += 1
                    if waited >= stopping.patience:
                        why = "patience"
                        break
            at, moved = 4, []
            for i, (_, schedule, start) in enumerate(blocks):
                g = total[at : at + len(flats[i])] / n + 2 * l2 * decay[i] * flats[i]
                at += len(flats[i])
                moved.append(flats[i] - rate_at(step, schedule) * g if step >= start else flats[i])
            flats = moved
    finally:
        data.unpersist()
    if history:
        history[-1] = (*history[-1][:4], why)
    kept = best[1] if stopping else flats
    trained = join([unpack(net, flat) for net, flat in zip(nets, kept)])
    return trained, loss_curve(df.sparkSession, history)


def loss_curve(spark, history: Sequence[tuple]) -> DataFrame:
    """Training history as a table; one row per step, the reason for the end on the last."""
    return spark.createDataFrame(history, "model string, step int, loss double, val_loss double, stopped string")


def score_net(df: DataFrame, x: Sequence[str], net: Net, outputs: Sequence[str] = ("yhat",)) -> DataFrame:
    """Outputs of a net on every row."""
    return through_arrays(df, x, lambda *columns: forward(net, np.stack(columns, axis=1).astype(float))[-1], outputs)


def through_arrays(df: DataFrame, inputs: Sequence[str | Column], use, outputs: Sequence[str]) -> DataFrame:
    """``df`` with columns of ``use``: arrays of the inputs in, an array of rows x outputs out.

    Only the inputs pass through Python; all other columns, keys above all, stay as they are.
    """
    kind = StructType([StructField(f"o{i}", DoubleType()) for i in range(len(outputs))])

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out = np.asarray(use(*(c.to_numpy() for c in columns)), float)
            yield pd.DataFrame({f"o{i}": out[:, i] for i in range(len(outputs))})

    given = [F.col(quoted(c)).cast("double") if isinstance(c, str) else c for c in inputs]
    scored = df.withColumn("_out", run(*given))
    return scored.withColumns({o: F.col(f"_out.o{i}") for i, o in enumerate(outputs)}).drop("_out")
