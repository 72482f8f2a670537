"""Log densities and learning-rate schedules as column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnLike, as_col, positive_scale

LOG_2PI = math.log(2.0 * math.pi)


def normal_nll(y: ColumnLike, mu: ColumnLike, log_sigma: ColumnLike) -> Column:
    """-ln N(y; mu, e^log_sigma) per row."""
    y, mu, log_sigma = as_col(y), as_col(mu), as_col(log_sigma)
    z = (y - mu) * F.exp(-log_sigma)
    return F.lit(0.5 * LOG_2PI) + log_sigma + F.lit(0.5) * z * z


def linked_nll(y: ColumnLike, loc: ColumnLike, raw_scale: ColumnLike, link: str = "softplus") -> Column:
    """-ln N(y; loc, scale) where the scale comes from an unbounded column.

    ``softplus``: scale = 0.001 + softplus(0.05 raw); ``exp``: scale = e^raw.
    """
    if link == "softplus":
        return normal_nll(y, loc, F.log(positive_scale(raw_scale)))
    if link == "exp":
        return normal_nll(y, loc, raw_scale)
    raise ValueError("link must be 'softplus' or 'exp'")


def diagonal_normal_log_prob(
    cols: Sequence[ColumnLike], loc: Sequence[float], scale: Sequence[float]
) -> Column:
    """Log density of independent normals, one per column."""
    if not len(cols) == len(loc) == len(scale):
        raise ValueError("cols, loc and scale must have the same length")
    total = F.lit(0.0)
    for c, m, s in zip(cols, loc, scale):
        total = total - normal_nll(as_col(c), F.lit(float(m)), F.lit(math.log(s)))
    return total


# Schedule of the four-step table: (first epoch after which it holds, rate); fixed values.
STEP_RATES = ((10000, 0.5e-5), (1000, 1e-4), (100, 1e-3))
STEP_RATE_START = 1e-2


def learning_rate(step: ColumnLike, schedule: Mapping) -> Column:
    """Learning rate of a step.

    ``{"kind": "constant", "rate": r}``, ``{"kind": "table"}`` or
    ``{"kind": "exponential", "rate": r, "decay": d, "steps": n, "floored": False}``.
    """
    step, kind = as_col(step), schedule["kind"]
    if kind == "constant":
        return F.lit(float(schedule["rate"]))
    if kind == "exponential":
        exponent = step.cast("double") / F.lit(float(schedule["steps"]))
        if schedule.get("floored", False):
            exponent = F.floor(exponent).cast("double")
        return F.lit(float(schedule["rate"])) * F.pow(F.lit(float(schedule["decay"])), exponent)
    if kind == "table":
        out = F
        for after, rate in STEP_RATES:
            out = out.when(step > after, F.lit(rate))
        return out.otherwise(F.lit(STEP_RATE_START))
    raise ValueError(f"unknown schedule {kind!r}")


def rate_at(step: int, schedule: Mapping) -> float:
    """The same schedules for the driver's step loop."""
    kind = schedule["kind"]
    if kind == "constant":
        return float(schedule["rate"])
    if kind == "exponential":
        exponent = step / schedule["steps"]
        if schedule.get("floored", False):
            exponent = math.floor(exponent)
        return schedule["rate"] * schedule["decay"] ** exponent
    if kind == "table":
        return next((rate for after, rate in STEP_RATES if step > after), STEP_RATE_START)
    raise ValueError(f"unknown schedule {kind!r}")
