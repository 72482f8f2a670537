"""Sorting, heads, shuffles, samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.scalars import quoted
from .joins import attach_scalars
from .quantiles import select_ranks


def sort_rows(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order)


def head_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First n rows; with an order the answer does not depend on the partitioning."""
    return (df.orderBy(*order) if order else df).limit(n)


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Random order that depends only on key and seed (a distributed sort by hash)."""
    h = F.xxhash64(F.col(quoted(key)), F.lit(seed).cast("bigint"))
    return df.orderBy(h, F.col(quoted(key)))


def _poisson_steps(mean: float) -> list[float]:
    """Distribution function of a Poisson variable at 0, 1, ... up to the last value a draw can exceed."""
    below, term, k, steps = 0.0, math.exp(-mean), 0, []
    while below < 1 - 2.0**-52 and k < 50 + 10 * mean:
        below += term
        steps.append(below)
        k += 1
        term *= mean / k
    return steps


def bootstrap_batch(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """Rows drawn with replacement; each row comes a Poisson(fraction) number of times.

    The number follows from the seed and the key (without one, from all columns, so equal rows are drawn alike), whatever
    the partitioning. Fractions over 100 are drawn as a sum of equal shares of at most 100.
    """
    k = draws.whole(df, key) if key else F.xxhash64(*(F.col(quoted(c)) for c in df.columns))
    shares = max(1, math.ceil(fraction / 100))
    steps = F.array(*(F.lit(p) for p in _poisson_steps(fraction / shares)))
    # each draw is bound to an array element, so that it is computed once, not once per step
    drawn = F.array(*(draws.uniform(k, F.lit(share), seed=seed) for share in range(shares)))
    counts = F.transform(drawn, lambda u: F.size(F.filter(steps, lambda p: u > p)))
    times = F.aggregate(counts, F.lit(0), lambda total, n: total + n)
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).drop("_copy")


def systematic_sample(df: DataFrame, key: str, every: int, offset: int = 0) -> DataFrame:
    """Every n-th id."""
    return df.where(F.col(quoted(key)) % every == offset)


def tail_split(df: DataFrame, key: str, held_out: float, name: str = "part") -> DataFrame:
    """Last share of the rows, in order of a unique key, as ``validation``; the rest is ``train``.

    The key at the border is selected exactly; no rows are numbered. A table too small for one training row has none.
    """
    kept = 1.0 - held_out
    training = lambda n: F.floor(n * F.lit(kept) + F.lit(1e-9))
    border = select_ranks(df, key, [(kept, (lambda n: F.greatest(training(n) - 1, F.lit(0)),))]).select(
        F.when(training(F.col("n")) > 0, F.col("values")[0]).alias("_border")
    )
    split = attach_scalars(df, border, _border=F.max("_border"))
    # without a border no row is for training
    train = F.col(quoted(key)) <= F.col("_border")
    return split.withColumn(name, F.when(train, F.lit("train")).otherwise(F.lit("validation"))).drop("_border")


def hash_split(df: DataFrame, key: str, held_out: float, seed: int = 0, name: str = "part") -> DataFrame:
    """Random split by the hash of a key: no pass over the data, stable when rows are added."""
    u = draws.uniform(draws.whole(df, key), seed=seed)
    return df.withColumn(name, F.when(u < held_out, F.lit("validation")).otherwise(F.lit("train")))
