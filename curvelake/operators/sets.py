"""Stacking tables and reshaping between wide and long."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted


def band_outline(df: DataFrame, order: str, x: str, lower: str, upper: str) -> DataFrame:
    """Closed outline of a band: lower curve forwards, then upper curve backwards.

    ``seq`` is the position by ``order``: the backward half counts down from there, so no
    row has to be numbered again; sort by (side, seq).
    """
    forward = df.select(F.lit(0).alias("side"), F.col(order).cast("bigint").alias("seq"), x, F.col(lower).alias("y"))
    backward = df.select(F.lit(1).alias("side"), (-F.col(order)).cast("bigint").alias("seq"), x, F.col(upper).alias("y"))
    return forward.unionByName(backward).orderBy("side", "seq")


def stack(tables: Mapping[str, DataFrame], label: str = "model") -> DataFrame:
    """One long table over models or runs, with the table's name as a column."""
    named = [t.withColumn(label, F.lit(n)) for n, t in tables.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), named)


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "series", value: str = "value"
) -> DataFrame:
    """Series columns to rows."""
    return df.unpivot([quoted(i) for i in ids], [quoted(v) for v in values], name, value)
