"""Exact order statistics without gathering a group in one place.

The built-in exact percentile keeps all values of a group in one buffer. Here a mergeable sketch
gives, per group and target, two values that enclose the wanted rank; one pass counts the
rows below and inside. The rows inside (a few thousandths of a group) are counted per value
and per slice, cut at the sketch's quantiles, and only the slice with the wanted rank is sorted. The
result is exact, and should a sketch miss its rank, the query fails instead of giving a
near value. Sketches are merged in two stages, by group and part first, so that no task merges those of all
tasks that read a group.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

from ..functions.scalars import quoted
from ..session import materialize
from .joins import attach_scalars, join_on_keys

Rank = Callable[[Column], Column]
Target = tuple[float, Sequence[Rank]]

#: Slices of equal width, and slices cut at quantiles.
SLICES, CUTS = 256, 64

#: Parts in which the sketches of a group are merged before they meet.
PARTS = 32

#: Numbers in the table of sketches up to which it is sent to all tasks that read rows (8 MB).
SENT = 1 << 20


def sketch_error(accuracy: int) -> float:
    """Rank error that a sketch of this size keeps with 99 in 100, as a share of the rows (Karnin, Lang and Liberty 2016)."""
    return 2.296 / accuracy**0.9021


def sketches(data: DataFrame, value: str, keys: Sequence[Column], ranks: Sequence[Sequence[float]], accuracy: int) -> DataFrame:
    """Per group ``_edges``: for each list of ranks the values near them, from sketches merged by part of the rows and then by group."""
    kind: DataType = data.schema[value].dataType
    asked = F.array(*(F.lit(float(r)) for rs in ranks for r in rs))
    v = F.col(quoted(value))
    if isinstance(kind, ByteType | ShortType | IntegerType | LongType):
        make, merge, read, count = F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, F.kll_sketch_get_n_bigint
        v = v.cast("bigint")
    elif isinstance(kind, FloatType | DoubleType):
        # the sketch knows no NaN: it is sketched as the largest number, and an upper end there is NaN again
        make, merge, read, count = F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, F.kll_sketch_get_n_double
        v = F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v.cast("double"))
    else:  # decimals and times
        flat = data.groupBy(*keys).agg(F.percentile_approx(v, asked, accuracy).alias("_flat"))
        return _nested(flat, ranks)
    size = F.lit(max(8, min(accuracy, 65_535)))
    names = [f"_k{i}" for i in range(len(keys))]
    parted = data.select(*(k.alias(n) for k, n in zip(keys, names)), v.alias("_v"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part"))
    parts = parted.groupBy(*names, "_part").agg(make("_v", size).alias("_sketch"))
    whole = parts.groupBy(*names).agg(merge("_sketch", size).alias("_sketch"))
    out = whole.select(*(F.col(n).alias(k) for n, k in zip(names, _names(data, keys))), F.when(count("_sketch") > 0, read("_sketch", asked)).alias("_flat"))
    return _nested(out, ranks)


def _names(data: DataFrame, keys: Sequence[Column]) -> list[str]:
    return data.select(*keys).columns if keys else []


def _nested(flat: DataFrame, ranks: Sequence[Sequence[float]]) -> DataFrame:
    at, parts = 1, []
    for rs in ranks:
        parts.append(F.slice("_flat", at, len(rs)))
        at += len(rs)
    return flat.withColumn("_edges", F.array(*parts)).drop("_flat")


def select_ranks(
    df: DataFrame, value: str, targets: Sequence[Target], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Values at given 0-based ranks of a sorted numeric column.

    A target is a fraction near which its ranks lie, and functions from the group's row count
    to the ranks. Returns the keys, ``n``, the target's number ``t`` and ``values``, the array of
    values at the ranks.
    """
    keys = [F.col(quoted(b)) for b in by]
    data = df.select(*keys, F.col(quoted(value)).alias("_v")).where(F.col("_v").isNotNull())
    k = len(targets)
    # Three times the sketch's error: a rank outside is all but impossible, and would raise.
    slack = 3.0 * sketch_error(accuracy)
    spans = [(max(p - slack, 0.0), min(p + slack, 1.0)) for p, _ in targets]
    ranks = [[lo + (hi - lo) * i / CUTS for i in range(CUTS + 1)] for lo, hi in spans]
    table = materialize(sketches(data, "_v", keys, ranks, accuracy))
    send = lambda t: t
    if by:
        # Spark guesses the table's size from the rows it was made of, and would sort all rows of a group in one task to join it
        few = table.count() * k * (CUTS + 1) <= SENT
        # dealt anew, a large one is measured and hot groups are split
        table = table if few else table.repartition(max(1, table.rdd.getNumPartitions()))
        send = F.broadcast if few else send
    edge = lambda i, j: F.col("_edges")[i][j]
    top = lambda c: F.when(c == float("inf"), F.lit(float("nan"))).otherwise(c)
    wide = isinstance(data.schema["_v"].dataType, FloatType | DoubleType)
    ends = F.array(*(edge(i, 0) for i in range(k)), *((top if wide else lambda c: c)(edge(i, CUTS)) for i in range(k)))
    framed = join_on_keys(data, send(table.select(*keys, ends.alias("_ends"))), by) if by else attach_scalars(data, table.select(ends.alias("_ends")), _ends=F.first("_ends"))
    low = [F.col("_ends")[i] for i in range(k)]
    high = [F.col("_ends")[k + i] for i in range(k)]
    return pick_ranks(framed, targets, low, high, by, cuts=send(table.select(*keys, F.col("_edges").alias("_cuts"))))


def pick_ranks(
    framed: DataFrame,
    targets: Sequence[Target],
    low: Sequence[Column],
    high: Sequence[Column],
    by: Sequence[str],
    weight: str | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """The same from rows ``_v`` that already know the ends of each target's bracket.

    ``weight`` names a column that says how many equal rows a row stands for. ``cuts`` has per group an array of ascending
    values for each target, ``_cuts``, at which its bracket is sliced; by default the slices are equally wide.
    """
    keys = [F.col(quoted(b)) for b in by]
    copies = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    v, slots = F.col("_v"), max(len(ranks) for _, ranks in targets)

    def inside(i: int) -> Column:
        return (v >= low[i]) & (v <= high[i])

    counts = (
        framed.groupBy(*keys)
        .agg(
            F.sum(copies).alias("n"),
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("t"),
                        F.sum(F.when(v < low[i], copies).otherwise(0)).alias("_below"),
                        F.sum(F.when(inside(i), copies).otherwise(0)).alias("_inside"),
                        F.max(F.when(v < low[i], v)).alias("_before"),
                        F.min(F.when(v > high[i], v)).alias("_after"),
                    )
                    for i in range(len(targets))
                ]
            ).alias("_targets"),
        )
        .select(*keys, "n", F.inline("_targets"))
    )
    # Wanted places, counted from the first row inside the bracket.
    place = F.lit(None)
    for i, (_, ranks) in enumerate(targets):
        padded = [*ranks, *[ranks[-1]] * (slots - len(ranks))]
        at = F.array(*[r(F.col("n")).cast("bigint") - F.col("_below") for r in padded])
        place = F.when(F.col("t") == i, at).otherwise(place)
    counts = counts.withColumn("_at", place)

    # Equal values are counted together first, so a frequent value is one row from here on.
    def slice_of(i: int) -> Column:
        if cuts is not None:
            return F.size(F.filter(F.col("_cuts")[i], lambda e: e <= v))
        share = F.try_divide(v.cast("double") - low[i].cast("double"), high[i].cast("double") - low[i].cast("double"))
        return F.least(F.coalesce(F.floor(share * SLICES), F.lit(0)), F.lit(SLICES - 1)).cast("int")

    hits = F.filter(
        F.array(
            *[
                F.when(inside(i), F.struct(F.lit(i).alias("t"), slice_of(i).alias("_slice")))
                for i in range(len(targets))
            ]
        ),
        lambda h: h.isNotNull(),
    )
    # The plain condition first: only the few rows in some bracket build arrays.
    near = functools.reduce(Column.__or__, [inside(i) for i in range(len(targets))])
    sliced = framed.where(near)
    if cuts is not None:  # the few rows in some bracket learn the cuts
        sliced = join_on_keys(sliced, cuts, by) if by else attach_scalars(sliced, cuts, _cuts=F.first("_cuts"))
    valued = (
        sliced.select(*keys, "_v", copies.alias("_rows"), F.explode(hits).alias("_hit"))
        .groupBy(*keys, F.col("_hit.t").alias("t"), F.col("_hit._slice").alias("_slice"), "_v")
        .agg(F.sum("_rows").alias("_rows"))
    )

    # Which slices hold a wanted place? A few hundred rows at most per group and target.
    slices = valued.groupBy(*keys, "t", "_slice").agg(F.sum("_rows").alias("_rows"))
    spine = slices.withColumn("_at", F.lit(None).cast("array<bigint>")).unionByName(
        counts.select(*keys, "t", F.lit(-1).alias("_slice"), F.lit(0).cast("bigint").alias("_rows"), "_at")
    )
    upto = Window.partitionBy(*keys, "t").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    spine = spine.withColumns({"_end": F.sum("_rows").over(upto), "_at": F.first("_at", True).over(upto)})
    holds = F.exists("_at", lambda r: (r >= F.col("_end") - F.col("_rows")) & (r < F.col("_end")))
    chosen = spine.where(holds).select(*keys, "t", "_slice", (F.col("_end") - F.col("_rows")).alias("_start"), "_at")

    order = Window.partitionBy(*keys, "t", "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    sorted_rows = join_on_keys(valued, chosen, [*by, "t", "_slice"]).withColumn(
        "_end", F.col("_start") + F.sum("_rows").over(order)
    )

    def found(i: int) -> Column:
        r = F.col("_at")[i]
        return F.when((r >= F.col("_end") - F.col("_rows")) & (r < F.col("_end")), v)

    names = [f"_found_{i}" for i in range(slots)]
    hit_rows = sorted_rows.select(*keys, "t", *[found(i).alias(n) for i, n in enumerate(names)])
    frame = ["n", "_inside", "_before", "_after", "_at"]
    merged = (
        counts.select(*keys, "t", *frame)
        .unionByName(hit_rows, allowMissingColumns=True)
        .groupBy(*keys, "t")
        .agg(*[F.max(c).alias(c) for c in [*frame, *names]])
    )
    missed = F.raise_error(F.lit("a rank lies outside its bracket; raise the accuracy"))
    values = [
        F.when(F.col("n").isNull(), F.lit(None))  # no rows at all
        .when(F.col("_at")[i] == -1, F.col("_before"))
        .when(F.col("_at")[i] == F.col("_inside"), F.col("_after"))
        .otherwise(F.coalesce(F.col(n), missed))
        for i, n in enumerate(names)
    ]
    return merged.select(*keys, "n", "t", F.array(*values).alias("values"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles, one named column each, per group or for the table."""
    names, ps = list(probs), list(probs.values())
    data = df.withColumn("_q", F.col(quoted(value)).cast("double"))

    def bounds(p: float) -> tuple[float, Sequence[Rank]]:
        place = lambda n: F.lit(p) * (n - 1)
        return p, (lambda n: F.floor(place(n)), lambda n: F.ceil(place(n)))

    at = select_ranks(data, "_q", [bounds(p) for p in ps], by, accuracy)
    p = F.element_at(F.array(*[F.lit(float(x)) for x in ps]), F.col("t") + 1)
    part = p * (F.col("n") - 1) - F.floor(p * (F.col("n") - 1))
    lo, hi = F.col("values")[0], F.col("values")[1]
    each = at.withColumn("_x", lo + part * (hi - lo))
    return each.groupBy(*[quoted(b) for b in by]).agg(
        *[F.max(F.when(F.col("t") == i, F.col("_x"))).alias(n) for i, n in enumerate(names)]
    )


def bounded_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str]
) -> DataFrame:
    """Interpolated quantiles by one buffer per group, for groups of a size fixed by a
    parameter (such as the runs per grid point)."""
    arr = F.percentile(F.col(quoted(value)), F.array(*[F.lit(float(p)) for p in probs.values()]))
    return df.groupBy(*[quoted(b) for b in by]).agg(arr.alias("_q")).select(
        *[quoted(b) for b in by], *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)]
    )
