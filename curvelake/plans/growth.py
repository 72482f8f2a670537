"""Indexed growth of groups over periods, line series and group dot tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import percent_change, percent_label, quoted, recode
from ..operators.aggregates import pivot_measures, pivot_values
from ..operators.windows import index_to_base, last_row


def period_stats(df: DataFrame, period: str, group: str, value: str, min_n: int = 0) -> DataFrame:
    """Count, mean and maximum of the value per group and period; null keys are left out.

    The count is of rows with a value. Only cells with more than ``min_n`` are kept.
    """
    stats = (
        df.dropna(subset=[quoted(period), quoted(group)])
        .groupBy(quoted(group), quoted(period))
        .agg(
            F.count(quoted(value)).alias("count"),
            F.avg(quoted(value)).alias(f"avg_{value}"),
            F.max(quoted(value)).alias(f"max_{value}"),
        )
    )
    return stats.where(F.col("count") > min_n)


def line_series(df: DataFrame, period: str, group: str, value: str, min_n: int = 0) -> DataFrame:
    """One series of means per group, in period order."""
    stats = period_stats(df, period, group, value, min_n)
    return stats.select(group, period, f"avg_{value}").orderBy(group, period)


def indexed_long(
    df: DataFrame, period: str, group: str, value: str, min_n: int = 0, base: str = "global"
) -> DataFrame:
    stats = period_stats(df, period, group, value, min_n)
    return index_to_base(stats, period, group, f"avg_{value}", f"{value}_to_base", base)


def indexed_growth(
    df: DataFrame,
    period: str,
    group: str,
    value: str,
    min_n: int = 0,
    groups: Sequence[str] | None = None,
    base: str = "global",
) -> DataFrame:
    """Wide table: one row per period with the mean and the mean relative to the base period
    for every group, as ``avg_<value>_<group>`` and ``<value>_to_base_<group>``."""
    long = indexed_long(df, period, group, value, min_n, base)
    if groups is None:
        groups = pivot_values(long, group)
    return pivot_measures(long, period, group, [f"avg_{value}", f"{value}_to_base"], groups)


def growth_labels(
    df: DataFrame,
    period: str,
    group: str,
    value: str,
    min_n: int = 0,
    names: Mapping[str, str] | None = None,
    base: str = "global",
) -> DataFrame:
    """Last point of every group's line, with the text of its change in percent."""
    long = indexed_long(df, period, group, value, min_n, base)
    last = last_row(long, [group], period, f"{value}_to_base")
    label = recode(group, names) if names else F.col(quoted(group))
    return last.withColumn("label", percent_label(percent_change(f"{value}_to_base"), label))


def dot_table(df: DataFrame, group: str, measures: Sequence[str], min_n: int, order: str) -> DataFrame:
    """Mean measures of the groups with at least ``min_n`` rows, sorted by one of them."""
    means = [F.avg(quoted(m)).alias(f"mean_{m}") for m in measures]
    grouped = df.dropna(subset=[quoted(group)]).groupBy(quoted(group)).agg(F.count(F.lit(1)).alias("_n"), *means)
    return grouped.where(F.col("_n") >= min_n).drop("_n").orderBy(quoted(f"mean_{order}"), quoted(group))
