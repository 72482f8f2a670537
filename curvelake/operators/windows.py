"""Values relative to their group, and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import quoted, ratio
from ..session import materialize
from .aggregates import group_count
from .joins import attach_group_values, attach_scalars, join_on_keys


def group_max(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """The group's maximum on each of its rows."""
    return attach_group_values(df, by, **{name: F.max(quoted(value))})


def group_fraction(df: DataFrame, x: str, fill: str) -> DataFrame:
    """Share of each fill value among the rows with the same x."""
    counts = group_count(df, [x, fill])
    totals = counts.groupBy(quoted(x)).agg(F.sum("count").alias("_total"))
    return join_on_keys(counts, totals, [x], "left").select(
        quoted(x), quoted(fill), "count", (F.col("count") / F.col("_total")).alias("fraction")
    )


def last_row(df: DataFrame, by: Sequence[str], period: str, value: str) -> DataFrame:
    """Last period and its value, per series."""
    return df.groupBy(*[quoted(b) for b in by]).agg(
        F.max(quoted(period)).alias(period), F.max_by(quoted(value), quoted(period)).alias(value)
    )


def index_to_base(
    df: DataFrame, period: str, group: str, value: str, name: str, base: str = "global"
) -> DataFrame:
    """Value divided by the group's value at the base period.

    ``global``: the first period of the whole table; a group without a row there has no base
    and gets null. ``group``: each group's own first period. ``df``, mostly an aggregate, is worked out once and written to the
    checkpoint folder; the base values are looked up there.
    """
    df = materialize(df)
    if base == "global":
        dated = attach_scalars(df, df, _first=F.min(quoted(period)))
        at_base = F.max(F.when(F.col(quoted(period)) == F.col("_first"), F.col(quoted(value))))
    elif base == "group":
        dated, at_base = df.withColumn("_first", F.lit(None)), F.min_by(quoted(value), quoted(period))
    else:
        raise ValueError("base must be 'global' or 'group'")
    with_base = attach_group_values(dated, [group], baseline=at_base)
    return with_base.drop("_first").withColumn(name, ratio(quoted(value), "baseline"))


def number_rows(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """Row numbers from 1 in a global order, without a one-task window.

    The sorted rows are written once with their place inside their partition. Only the row
    counts of the partitions (as many as shuffle partitions) are then summed up in order.
    """
    # 33 low bits count the rows inside a partition, the bits above number the partition.
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright("_place", 33)
    placed = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + inside + 1)
        .drop("_part", "_place", "_start")
    )


def group_ranks(df: DataFrame, key: str, name: str = "rank") -> DataFrame:
    """Position of every group in the list by size, equal sizes in key order."""
    counts = group_count(df.dropna(subset=[quoted(key)]), [key])
    return number_rows(counts, [F.desc("count"), F.asc(quoted(key))], name)


def top_groups(df: DataFrame, key: str, k: int, name: str = "rank") -> DataFrame:
    """The k most frequent values with their rank."""
    counts = group_count(df.dropna(subset=[quoted(key)]), [key])
    top = counts.orderBy(F.desc("count"), F.asc(quoted(key))).limit(k)
    order = Window.orderBy(F.desc("count"), F.asc(quoted(key)))  # k rows
    return top.withColumn(name, F.row_number().over(order))
