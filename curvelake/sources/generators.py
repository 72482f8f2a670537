"""Grids and synthetic samples.

Every ``*_over`` function turns rows that already have a key into samples, so it runs
on any table; the others start from ``spark.range``. Draws come from row keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.scalars import ColumnLike, as_col


def linspace(spark: SparkSession, lo: float, hi: float, n: int, name: str = "x") -> DataFrame:
    """n evenly spaced points, both ends included."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return spark.range(n).select(
        F.col("id").alias("grid_id"), (F.lit(float(lo)) + F.col("id") * F.lit(step)).alias(name)
    )


def linspace_over(df: DataFrame, col: str, n: int, name: str = "x") -> DataFrame:
    """Grid of n points from the least to the greatest value of a column."""
    if n < 2:
        raise ValueError("a grid needs at least 2 points")
    ends = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")))
    grid = df.sparkSession.range(n).withColumn("_ends", ends.scalar())
    span = F.col("_ends.hi") - F.col("_ends.lo")
    return grid.select(
        F.col("id").alias("grid_id"),
        (F.col("_ends.lo") + F.col("id") * span / F.lit(float(n - 1))).alias(name),
    )


def sine_curve(x: ColumnLike) -> Column:
    """The truth curve 3 sin x."""
    return F.lit(3.0) * F.sin(as_col(x))


def sine_over(df: DataFrame, key: str, x: ColumnLike, noise: float = 1.0, seed: int = 0) -> DataFrame:
    """key, x and y = 3 sin x + N(0, noise)."""
    return df.select(
        F.col(key),
        as_col(x).alias("x"),
        (sine_curve(x) + F.lit(noise) * draws.normal(draws.whole(df, key), seed=seed)).alias("y"),
    )


def sine_data(spark: SparkSession, n: int = 300, noise: float = 1.0, seed: int = 0) -> DataFrame:
    """n evenly spaced x on [0, 2 pi] with noisy sine values."""
    x = F.col("id") * F.lit(2 * math.pi / max(n - 1, 1))
    return sine_over(spark.range(n), "id", x, noise, seed)


def polynomial(x: ColumnLike, coefs: Sequence[float]) -> Column:
    """Polynomial with the constant term first, by Horner's rule."""
    x, out = as_col(x), F.lit(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        out = out * x + F.lit(float(c))
    return out


# Constant, x, x^2 and x^3 of the noise-free test polynomial.
TEST_POLYNOMIAL = (5.0, 10.0, -3.0, 6.0)


def polynomial_data(
    spark: SparkSession, xs: Sequence[float] = tuple(range(11)), coefs: Sequence[float] = TEST_POLYNOMIAL
) -> DataFrame:
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id bigint, x double")
    return df.withColumn("y", polynomial("x", coefs))


def two_moons_over(df: DataFrame, key: str, noise: float = 0.05, seed: int = 0) -> DataFrame:
    """Two interleaved half circles; each key lands on a moon (draw 0) and an angle (draw 1), then moves by draws 2 and 3."""
    k = draws.whole(df, key)
    upper = draws.uniform(k, F.lit(0), seed=seed) < 0.5
    angle = F.lit(math.pi) * draws.uniform(k, F.lit(1), seed=seed)
    wobble = [F.lit(noise) * draws.normal(k, F.lit(draw), seed=seed) for draw in (2, 3)]
    return df.select(
        F.col(key),
        (F.when(upper, F.cos(angle)).otherwise(1.0 - F.cos(angle)) + wobble[0]).alias("x1"),
        (F.when(upper, F.sin(angle)).otherwise(0.5 - F.sin(angle)) + wobble[1]).alias("x2"),
        F.when(upper, 0).otherwise(1).alias("moon"),
    )


def two_moons(spark: SparkSession, n: int = 3000, noise: float = 0.05, seed: int = 0) -> DataFrame:
    return two_moons_over(spark.range(n), "id", noise, seed)


def banana_over(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """x2 ~ N(0, 4), x1 ~ N(x2^2 / 4, 1), both divided by 40."""
    k = draws.whole(df, key)
    x2 = F.lit(4.0) * draws.normal(k, F.lit(2), seed=seed)
    return df.select(F.col(key), x2.alias("_x2"), draws.normal(k, F.lit(1), seed=seed).alias("_x1")).select(
        F.col(key),
        ((F.col("_x2") * F.col("_x2") / 4 + F.col("_x1")) / 40).alias("x1"),
        (F.col("_x2") / 40).alias("x2"),
    )


def banana_data(spark: SparkSession, n: int = 1500, seed: int = 0) -> DataFrame:
    return banana_over(spark.range(n), "id", seed)


def uniform_box_over(df: DataFrame, key: str, d: int = 2, seed: int = 0) -> DataFrame:
    """d independent uniform(-1, 1) columns per key."""
    return df.select(
        F.col(key), *[(draws.uniform(draws.whole(df, key), F.lit(i), seed=seed) * 2 - 1).alias(f"x{i + 1}") for i in range(d)]
    )


def normal_box_over(df: DataFrame, key: str, d: int = 2, seed: int = 0) -> DataFrame:
    """d independent N(0, 1) columns per key."""
    return df.select(
        F.col(key), *[draws.normal(draws.whole(df, key), F.lit(i), seed=seed).alias(f"x{i + 1}") for i in range(d)]
    )


def uniform_box(spark: SparkSession, n: int, d: int = 2, seed: int = 0) -> DataFrame:
    return uniform_box_over(spark.range(n), "id", d, seed)


def normal_box(spark: SparkSession, n: int, d: int = 2, seed: int = 0) -> DataFrame:
    return normal_box_over(spark.range(n), "id", d, seed)
