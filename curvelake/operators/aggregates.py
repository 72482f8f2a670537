"""Group statistics, contingency tables, pivots and the counts behind charts.

Group-bys here use only functions that combine inside tasks first, so a key with a third
of all rows costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from .joins import attach_scalars, join_on_keys, keep_groups, ordered_lookup
from .quantiles import exact_quantiles


def _keys(df: DataFrame, by: Sequence[str], drop_null_keys: bool) -> DataFrame:
    return df.dropna(subset=[quoted(b) for b in by]) if drop_null_keys and by else df


def group_count(df: DataFrame, by: Sequence[str], name: str = "count", drop_null_keys: bool = False) -> DataFrame:
    return _keys(df, by, drop_null_keys).groupBy(*[quoted(b) for b in by]).agg(F.count("*").alias(name))


def group_mean(
    df: DataFrame, by: Sequence[str], values: Sequence[str], order: bool = False, drop_null_keys: bool = False
) -> DataFrame:
    """Mean of one or more columns per group, sorted by the keys on request."""
    out = _keys(df, by, drop_null_keys).groupBy(*[quoted(b) for b in by]).agg(
        *[F.avg(quoted(v)).alias(f"mean_{v}") for v in values]
    )
    return out.orderBy(*[quoted(b) for b in by]) if order else out


def group_stats(
    df: DataFrame, by: Sequence[str], drop_null_keys: bool = False, **stats: Column
) -> DataFrame:
    """Several named aggregates per group; without keys one row for the whole table."""
    named = [v.alias(n) for n, v in stats.items()]
    return _keys(df, by, drop_null_keys).groupBy(*[quoted(b) for b in by]).agg(*named)


def value_counts(df: DataFrame, col: str, drop_null_keys: bool = True) -> DataFrame:
    """Count per value, most frequent first, equal counts in key order."""
    return group_count(df, [col], drop_null_keys=drop_null_keys).orderBy(F.desc("count"), F.asc(quoted(col)))


def having_count(df: DataFrame, by: Sequence[str], at_least: int) -> DataFrame:
    """Groups with enough rows, with their counts."""
    return group_count(df, by).where(F.col("count") >= at_least)


def crosstab(
    df: DataFrame, rows: str, columns: str, values: Sequence | None = None, drop_null_keys: bool = True
) -> DataFrame:
    """Contingency counts with one column per value of the second key.

    Give ``values`` when they are known: finding them costs one more pass. Spark refuses a
    pivot with more values than ``spark.sql.pivotMaxValues``.
    """
    data = _keys(df, [rows, columns], drop_null_keys)
    return data.groupBy(quoted(rows)).pivot(quoted(columns), values).count().na.fill(0)


def crosstab_ordered(
    df: DataFrame,
    rows: str,
    columns: str,
    top: DataFrame,
    rank: str,
    values: Sequence | None = None,
    reverse: bool = False,
) -> DataFrame:
    """Contingency counts for the listed row keys only, in list order or reversed."""
    table = crosstab(keep_groups(df, top, [rows]), rows, columns, values)
    return ordered_lookup(table, top, rows, rank, reverse=reverse)


def pivot_measures(
    df: DataFrame, index: str, columns: str, measures: Sequence[str], values: Sequence | None = None
) -> DataFrame:
    """Wide table: one row per index value, one column ``measure_value`` per measure and
    pivot value. A second row for the same cell is an error."""
    cells = df.groupBy(quoted(index), quoted(columns)).agg(
        F.count("*").alias("_rows"), *[F.first(quoted(m)).alias(m) for m in measures]
    )
    message = F.lit(f"more than one row for a cell of {index} and {columns}")
    checked = cells.select(
        quoted(index),
        quoted(columns),
        *[F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.col(quoted(m))).alias(m) for m in measures],
    )
    if values is None:
        values = pivot_values(df, columns)
    wide = checked.groupBy(quoted(index)).pivot(quoted(columns), list(values)).agg(
        *[F.first(quoted(m)).alias(m) for m in measures]
    )
    return flatten_names(wide, index, measures, values)


def pivot_values(df: DataFrame, columns: str) -> list:
    """Sorted values of a pivot column; more than ``spark.sql.pivotMaxValues`` are an error."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(quoted(columns)).dropna().distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{columns} has more than {limit} values")
    return sorted(r[0] for r in found)


def flatten_names(wide: DataFrame, index: str, measures: Sequence[str], values: Sequence) -> DataFrame:
    """Columns of a pivot as ``measure_value``, all values of a measure side by side."""
    if len(measures) == 1:
        source = {(measures[0], v): f"{v}" for v in values}
    else:
        source = {(m, v): f"{v}_{m}" for m in measures for v in values}
    return wide.select(
        quoted(index), *[F.col(quoted(source[m, v])).alias(f"{m}_{v}") for m in measures for v in values]
    )


def facet_stats(df: DataFrame, facets: Sequence[str], by: Sequence[str], **stats: Column) -> DataFrame:
    """The same statistics in every panel: facet keys in front of the group keys."""
    return group_stats(df, [*facets, *by], **stats)


# --- histograms -----------------------------------------------------------------------

def histogram_width(
    df: DataFrame, value: str, width: float, origin: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per bin [start, start + width) (per fill group)."""
    slot = F.floor((F.col(quoted(value)).cast("double") - F.lit(origin)) / F.lit(width))
    counts = (
        df.where(F.col(quoted(value)).isNotNull())
        .groupBy(*[quoted(b) for b in by], slot.alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    return counts.withColumn("bin_start", F.lit(origin) + F.col("bin") * F.lit(width)).withColumn(
        "bin_end", F.lit(origin) + (F.col("bin") + 1) * F.lit(width)
    )


def freq_polygon(
    df: DataFrame, value: str, width: float, origin: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    """Bin mid-points and counts per group."""
    bins = histogram_width(df, value, width, origin, by)
    return bins.select(*[quoted(b) for b in by], (F.col("bin_start") + F.lit(width / 2)).alias("mid"), "count")


def histogram_bins(df: DataFrame, value: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins between the least and the greatest value of the whole table.

    The last bin is closed. Empty bins have count 0. When all values are equal the range
    is widened by one half on both sides.
    """
    data = df.select(*[F.col(quoted(b)) for b in by], F.col(quoted(value)).cast("double").alias("_v")).where(
        F.col("_v").isNotNull()
    )
    ends = dict(_min=F.min("_v"), _max=F.max("_v"))
    flat = F.col("_min") == F.col("_max")
    lo = F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min"))
    hi = F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max"))
    slot = F.least(F.floor((F.col("_v") - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1))
    counts = (
        attach_scalars(data, data, **ends)
        .select(*[quoted(b) for b in by], slot.cast("bigint").alias("bin"))
        .groupBy(*[quoted(b) for b in by], "bin")
        .agg(F.count("*").alias("count"))
    )
    if by:
        frame = counts.select(*[quoted(b) for b in by]).distinct().select(
            "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin")
        )
    else:
        frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return attach_scalars(join_on_keys(frame, counts, [*by, "bin"], "left"), data, **ends).select(
        *[quoted(b) for b in by],
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def density_histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Counts divided by rows and bin width: the bars have area 1."""
    counts = histogram_bins(df, value, bins)
    width = F.col("bin_end") - F.col("bin_start")
    return attach_scalars(counts, counts, _total=F.sum("count")).select(
        "bin", "bin_start", "bin_end", "count", (F.col("count") / (F.col("_total") * width)).alias("density")
    )


def stacked_counts(df: DataFrame, x: str, fill: str) -> DataFrame:
    return group_count(df, [x, fill])


# --- summaries ------------------------------------------------------------------------

def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Quartiles, whisker ends at 1.5 interquartile ranges and the number of outliers."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, accuracy)
    fenced = _with_fences(df, quartiles, value, by)
    v, inside = F.col("_v"), F.col("_v").between(F.col("_low"), F.col("_high"))
    ends = fenced.groupBy(*[quoted(b) for b in by]).agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, v)).alias("outliers"),
        F.count(v).alias("count"),
    )
    if by:
        return join_on_keys(quartiles, ends, by)
    return attach_scalars(quartiles, ends, **{c: F.max(c) for c in ends.columns})


def box_outliers(df: DataFrame, value: str, by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Rows beyond the whiskers."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}, by, accuracy)
    fenced = _with_fences(df, quartiles, value, by)
    return fenced.where(~F.col("_v").between(F.col("_low"), F.col("_high"))).select(
        *[F.col(quoted(c)) for c in df.columns]
    )


def _with_fences(df: DataFrame, quartiles: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    fences = quartiles.select(
        *[quoted(b) for b in by], (F.col("q1") - reach).alias("_low"), (F.col("q3") + reach).alias("_high")
    )
    data = df.withColumn("_v", F.col(quoted(value)).cast("double")).where(F.col("_v").isNotNull())
    if by:
        return join_on_keys(data, fences, by)
    return attach_scalars(data, fences, _low=F.max("_low"), _high=F.max("_high"))


def mean_sd(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation, one row per column, in one pass."""
    pairs = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(quoted(c)).alias("mean"),
            F.stddev_pop(quoted(c)).alias("sd"),
        )
        for c in cols
    ]
    return df.agg(F.array(*pairs).alias("s")).select(F.inline("s"))


def coefficient_table(coefs: DataFrame, models: Sequence[str]) -> DataFrame:
    """Long coefficients (model, term, value) to one row per term and one column per model."""
    return coefs.groupBy("term").pivot("model", list(models)).agg(F.first("value")).orderBy("term")
