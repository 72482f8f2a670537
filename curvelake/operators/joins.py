"""Join-shaped operators.

No operator builds a cross product. One-row values are attached as scalar subqueries,
bounded axes are exploded per row, and other joins are equi-joins whose strategy Spark
picks from the sizes it sees (broadcast below its threshold, skew-split sort-merge above).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted


def fresh(prefix: str) -> str:
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches null keys; the keys appear once, from the left."""
    names = {k: fresh("key") for k in keys}
    renamed = right.select(
        *[F.col(quoted(c)).alias(names.get(c, c)) for c in right.columns]
    )
    matches = [F.col(quoted(k)).eqNullSafe(F.col(names[k])) for k in keys]
    return left.join(renamed, functools.reduce(Column.__and__, matches), how).drop(*names.values())


def equi_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Inner or left join on pairs of left and right columns."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    matches = [left[quoted(a)] == right[quoted(b)] for a, b in on.items()]
    return left.join(right, functools.reduce(Column.__and__, matches), how)


def keep_groups(df: DataFrame, groups: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in a computed list."""
    return df.join(groups.select(*on), list(on), "left_semi")


def ordered_lookup(
    df: DataFrame, ranked: DataFrame, on: str, rank: str, then: Sequence[str] = (), reverse: bool = False
) -> DataFrame:
    """Rows of the listed keys, in the order of the list or its reverse.

    A row number ends the sort key: without it all rows of a frequent key would be sorted in
    one task.
    """
    tie = fresh("tie")
    joined = df.withColumn(tie, F.monotonically_increasing_id()).join(ranked.select(on, rank), on, "inner")
    return joined.orderBy(F.desc(rank) if reverse else F.asc(rank), *then, tie).drop(tie)


def attach_scalars(df: DataFrame, source: DataFrame, **values: Column) -> DataFrame:
    """Global aggregates of ``source`` as columns on every row of ``df``.

    They are computed once, as a scalar subquery; nothing is joined.
    """
    one = source.agg(F.struct(*[v.alias(n) for n, v in values.items()]))
    holder = fresh("scalars")
    return (
        df.withColumn(holder, one.scalar())
        .withColumns({n: F.col(holder)[n] for n in values})
        .drop(holder)
    )


def attach_group_values(df: DataFrame, by: Sequence[str], **values: Column) -> DataFrame:
    """Aggregates of each group as columns on all its rows.

    Aggregates first (with partial sums in every task) and joins the small result back. A
    window over the raw rows would put a whole group into one task.
    """
    totals = df.groupBy(*[F.col(quoted(b)) for b in by]).agg(*[v.alias(n) for n, v in values.items()])
    return join_on_keys(df, totals, by, "left")


def repeat_runs(df: DataFrame, runs: int, name: str = "run") -> DataFrame:
    """Every row once per run 0 .. runs-1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def spread_over_grid(df: DataFrame, grid: Sequence[float], x: str = "grid_x", key: str = "grid_id") -> DataFrame:
    """Every row once per point of a small fixed grid, ready for a partial aggregation.

    The copies live only inside a task: callers aggregate by grid point at once.
    """
    points = F.array(*[F.lit(float(g)) for g in grid])
    return df.select("*", F.posexplode(points).alias(key, x))


def fill_axis(df: DataFrame, axis: str, by: Sequence[str] = ()) -> DataFrame:
    """Every whole number from the least to the greatest axis value (per group, over the
    common range), with null measures where there was no row."""
    ends = df.agg(F.struct(F.min(axis).alias("lo"), F.max(axis).alias("hi")))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    full = groups.withColumn("_ends", ends.scalar()).select(
        *by, F.explode(F.sequence(F.col("_ends.lo"), F.col("_ends.hi"))).alias(axis)
    )
    return join_on_keys(full, df, [*by, axis], "left")
