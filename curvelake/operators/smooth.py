"""Trend lines, bands, local regression and kernel densities on a small grid."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from .joins import attach_scalars, spread_over_grid
from .quantiles import pick_ranks


def group_lm(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Straight line per group, with r squared and row count. A group without spread in x
    has null slope."""
    xc, yc = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    return df.groupBy(*[quoted(b) for b in by]).agg(
        F.regr_slope(yc, xc).alias("slope"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.regr_r2(yc, xc).alias("r2"),
        F.regr_count(yc, xc).alias("n"),
    )


def lm_band(
    df: DataFrame, x: str, y: str, grid: Sequence[float], t: float = 1.96, by: Sequence[str] = ()
) -> DataFrame:
    """Line and band of its mean response, yhat +- t s sqrt(1/n + (x - mean)^2 / Sxx), at the
    grid points. ``t`` is the Student quantile for n - 2 degrees of freedom."""
    xc, yc = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    sums = df.groupBy(*[quoted(b) for b in by]).agg(
        F.regr_slope(yc, xc).alias("_b"),
        F.regr_intercept(yc, xc).alias("_a"),
        F.regr_avgx(yc, xc).alias("_mx"),
        F.regr_sxx(yc, xc).alias("_sxx"),
        F.regr_syy(yc, xc).alias("_syy"),
        F.regr_count(yc, xc).alias("_n"),
    )
    left_over = F.greatest(F.col("_syy") - F.col("_b") * F.col("_b") * F.col("_sxx"), F.lit(0.0))
    s2 = F.try_divide(left_over, F.col("_n") - 2)
    gap = F.col("grid_x") - F.col("_mx")
    half = F.lit(t) * F.sqrt(s2 * (F.lit(1.0) / F.col("_n") + gap * gap / F.col("_sxx")))
    fit = F.col("_a") + F.col("_b") * F.col("grid_x")
    return spread_over_grid(sums, grid).select(
        *[quoted(b) for b in by],
        "grid_id",
        "grid_x",
        fit.alias("fit"),
        (fit - half).alias("lower"),
        (fit + half).alias("upper"),
    )


def _local_fit(degree: int) -> Column:
    """Value at the grid point from weighted sums of the offset u: s0.. and t0.. (with y)."""
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))
    mean = F.try_divide(t0, s0)
    line = F.try_divide(s2 * t0 - s1 * t1, s0 * s2 - s1 * s1)
    if degree == 1:
        return F.coalesce(line, mean)
    det = s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)
    top = t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)
    return F.coalesce(F.try_divide(top, det), line, mean)


def _reach_brackets(
    edges: np.ndarray, n: int, points: Sequence[float], k: int, error: float
) -> tuple[list[float], list[float]]:
    """Distances that enclose the k-th nearest row of each point, from approximate quantiles.

    The number of rows within a distance lies between bounds read off the quantiles; the
    lower end has surely fewer than k rows, the upper end surely k or more.
    """
    shares = np.linspace(0.0, 1.0, len(edges))
    most, least = np.append((shares + error) * n, n), np.concatenate([[0.0], (shares - error) * n])
    least[-1] = n
    low, high = [], []
    for g in points:
        reach = np.unique(np.abs(edges - g))
        right, left = g + reach, g - reach
        upto_r, upto_l = np.searchsorted(edges, right, "right"), np.searchsorted(edges, left, "left")
        at_most = most[upto_r] - np.maximum(least[upto_l], 0.0)
        before = np.where(upto_l == 0, 0.0, most[upto_l])
        at_least = np.maximum(least[upto_r], 0.0) - before
        fewer, enough = reach[at_most < k], reach[at_least >= k]
        low.append(float(fewer.max()) if len(fewer) else 0.0)
        high.append(float(enough.min()) if len(enough) else float(reach.max()))
    return low, high


def loess_grid(
    df: DataFrame, x: str, y: str, grid: Sequence[float], span: float = 0.75, degree: int = 1, accuracy: int = 10_000
) -> DataFrame:
    """Local polynomial of degree 1 or 2 with tricube weights at each point of a small grid.

    The window of a point reaches to its k-th nearest row, k = floor(span n). One sketch of x
    (a fixed number of quantiles goes to the driver) encloses that distance for every point;
    the exact order statistic of |x - point| is then picked inside, so no point sorts the table.
    The local sums are one aggregation with as many groups as grid points.
    """
    if degree not in (1, 2):
        raise ValueError("degree must be 1 or 2")
    points = [float(g) for g in grid]
    data = df.select(F.col(quoted(x)).cast("double").alias("_x"), F.col(quoted(y)).cast("double").alias("_y")).dropna()
    shares = F.split(F.lit(",".join(str(i / 2000) for i in range(2001))), ",").cast("array<double>")
    row = data.agg(F.count("*").alias("n"), F.percentile_approx("_x", shares, accuracy).alias("edges")).first()
    k = max(math.floor(row["n"] * span + 1e-5), 1)
    low, high = _reach_brackets(np.array(row["edges"] or [0.0]), row["n"], points, k, 2.0 / accuracy)

    def of_point(values: Sequence[float]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("grid_id"))

    # Rows with equal x act as one row with their count and summed y; nothing is lost.
    merged = data.groupBy("_x").agg(F.count("*").alias("_c"), F.sum("_y").alias("_y"))
    away = spread_over_grid(merged, points).select("grid_id", "_c", F.abs(F.col("_x") - F.col("grid_x")).alias("_v"))
    kth = (0.0, (lambda n: F.lit(k - 1),))
    reach = pick_ranks(away, [kth], [of_point(low)], [of_point(high)], ["grid_id"], "_c").select(
        "grid_id", F.col("values")[0].alias("h")
    )
    # One number per grid point, put in grid order into one array.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("grid_id", "h"))), lambda s: s["h"])
    near = attach_scalars(merged, reach, _h=ordered)
    near = spread_over_grid(near, points).select(
        "grid_id",
        "grid_x",
        "_y",
        "_c",
        (F.col("_x") - F.col("grid_x")).alias("u"),
        F.get("_h", F.col("grid_id")).alias("h"),
    )
    # Offsets in units of the reach keep the sums of powers of like size.
    near = near.where(F.abs("u") < F.col("h")).withColumn("u", F.col("u") / F.col("h"))
    near = near.withColumn("k", F.pow(1 - F.pow(F.abs("u"), 3), 3)).withColumn("w", F.col("k") * F.col("_c"))
    w, u, ky = F.col("w"), F.col("u"), F.col("k") * F.col("_y")
    sums = near.groupBy("grid_id", "grid_x").agg(
        F.sum(w).alias("s0"),
        F.sum(w * u).alias("s1"),
        F.sum(w * u * u).alias("s2"),
        F.sum(w * u * u * u).alias("s3"),
        F.sum(w * u * u * u * u).alias("s4"),
        F.sum(ky).alias("t0"),
        F.sum(u * ky).alias("t1"),
        F.sum(u * u * ky).alias("t2"),
    )
    return sums.select("grid_id", "grid_x", _local_fit(degree).alias("fit"))


#: Moments that a bin of half a bandwidth keeps. What is left out of a row's kernel is below 1.09 * 0.25^12 / sqrt(12!), some 3e-12 of its height
#: (Cramer's bound on Hermite functions).
MOMENTS = 12


def _kernel_terms() -> np.ndarray:
    """[k, m]: what the m-th moment of a bin, over m!, adds to the coefficient of z^k (Hermite polynomials He_m)."""
    terms = np.zeros((MOMENTS, MOMENTS))
    for m in range(MOMENTS):
        he = np.polynomial.hermite_e.herme2poly(np.eye(MOMENTS)[m])
        terms[: len(he), m] = he / math.factorial(m)
    return terms


def _binned_kernel(rows: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Sums of Gaussian kernels of rows (_x, _bw, _n, _lo) at the grid: rows meet in bins of half a bandwidth, and bins meet the grid.

    exp(-(z - d)^2 / 2) is exp(-z^2 / 2) times the sum of He_m(z) d^m / m!, with d a row's place in its bin and z the bin's distance from the
    grid point. So the sums of d^m say all that is needed of a bin.
    """
    width = F.nullif(F.col("_bw"), F.lit(0.0))
    slots = rows.withColumn("_at", (F.col("_x") - F.col("_lo")) / width).withColumn("_slot", F.floor(F.col("_at") * 2))
    placed = slots.withColumn("_d", F.col("_at") - (F.col("_slot") + F.lit(0.5)) / 2)
    moments = [F.sum(F.pow("_d", F.lit(float(m)))).alias(f"_m{m}") for m in range(MOMENTS)]
    bins = placed.groupBy("_slot", "_bw", "_n", "_lo").agg(*moments)
    parts = [
        sum((F.lit(float(c)) * F.col(f"_m{m}") for m, c in enumerate(line) if c), F.lit(0.0)).alias(f"_c{k}") for k, line in enumerate(_kernel_terms())
    ]
    centre = (F.col("_lo") + (F.col("_slot") + F.lit(0.5)) / 2 * F.col("_bw")).alias("_x")
    met = spread_over_grid(bins.select("_bw", "_n", centre, *parts), grid)
    z = (F.col("grid_x") - F.col("_x")) / width
    value = F.lit(0.0)
    for k in range(MOMENTS - 1, -1, -1):
        value = value * F.col("_z") + F.col(f"_c{k}")
    return met.withColumn("_z", z).withColumn("_height", F.exp(F.lit(-0.5) * F.col("_z") * F.col("_z")) * value)


def kde_grid(df: DataFrame, x: str, grid: Sequence[float], bw: float | None = None, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density at the points of a small grid.

    Without a bandwidth Scott's rule is used: sample sd times n^(-1/5). Rows are summed up in bins of half a bandwidth, by moments that make
    up the kernel to 3e-12 of its height, and only bins meet the grid. ``bins`` takes that many equal bins instead and puts all
    rows of a bin at its centre; the error is of the order (bin width / bandwidth)^2. Where all values are equal the density is null.
    """
    data = df.select(F.col(quoted(x)).cast("double").alias("_x")).dropna()
    spread = F.stddev_samp("_x") * F.pow(F.count("_x").cast("double"), F.lit(-0.2))
    width = F.max(F.lit(float(bw))) if bw is not None else spread
    ends = attach_scalars(data, data, _bw=width, _n=F.count("_x"), _lo=F.min("_x"), _hi=F.max("_x"))
    scale = F.lit(math.sqrt(2 * math.pi)) * F.nullif(F.max("_bw"), F.lit(0.0)) * F.max("_n")
    if bins is None:
        met, height = _binned_kernel(ends, grid), F.sum("_height")
    else:
        step = F.nullif((F.col("_hi") - F.col("_lo")) / F.lit(float(bins)), F.lit(0.0))
        slot = F.least(F.floor((F.col("_x") - F.col("_lo")) / step), F.lit(bins - 1))
        centre = F.coalesce(F.col("_lo") + (slot + 0.5) * step, F.col("_x"))
        rows = ends.groupBy(centre.alias("_x"), "_bw", "_n").agg(F.count("*").cast("double").alias("_w"))
        z = (F.col("_x") - F.col("grid_x")) / F.col("_bw")
        met, height = spread_over_grid(rows, grid), F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z))
    return met.groupBy("grid_id", "grid_x").agg((height / scale).alias("density"))
