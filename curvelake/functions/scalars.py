"""Scalar column functions: casts, labels, dates, recoding and elementary mathematics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Name in back-ticks, so that ``MPG.city`` means one column and not a struct field."""
    return "`" + name.replace("`", "``") + "`"


# --- projection and names -------------------------------------------------------------

def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(quoted(n)) for n in names])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def row_label(df: DataFrame, name: str, parts: Sequence[str], sep: str = " ") -> DataFrame:
    """Explicit key column in place of a data frame's row names."""
    return df.withColumn(name, F.concat_ws(sep, *[F.col(quoted(p)).cast("string") for p in parts]))


# --- casts and labels -----------------------------------------------------------------

def lenient_double(c: ColumnLike) -> Column:
    """Text to double; text that is no number becomes null."""
    return as_col(c).try_cast("double")


def strict_double(c: ColumnLike) -> Column:
    """Text to double; text that is no number fails the query."""
    return as_col(c).cast("double")


def number_label(c: ColumnLike) -> Column:
    """Number as category label in its own type: 6.0 gives ``6.0``."""
    return as_col(c).cast("string")


def whole_label(c: ColumnLike) -> Column:
    """Number as category label without decimals: 6.0 gives ``6``."""
    return as_col(c).cast("bigint").cast("string")


def recode(c: ColumnLike, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    source, out = as_col(c), None
    for old, new in mapping.items():
        out = (F if out is None else out).when(source == F.lit(old), F.lit(new))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def first_token(c: ColumnLike) -> Column:
    """Text before the first blank; null if there is no token."""
    return F.nullif(F.regexp_extract(as_col(c), r"(\S+)", 1), F.lit(""))


def percent_label(change: ColumnLike, label: ColumnLike) -> Column:
    """``12.34% label`` with two decimals."""
    return F.format_string("%.2f%% %s", as_col(change), as_col(label))


# --- arithmetic -----------------------------------------------------------------------

def modulus(c: ColumnLike, n: int) -> Column:
    return as_col(c) % F.lit(n)


def year_of(c: ColumnLike) -> Column:
    return F.year(as_col(c))


def ratio(value: ColumnLike, base: ColumnLike) -> Column:
    """value / base; a base of zero gives null instead of an error."""
    return F.try_divide(as_col(value).cast("double"), as_col(base).cast("double"))


def percent_change(index: ColumnLike) -> Column:
    """Index with base 1 to change in percent."""
    return as_col(index) * F.lit(100.0) - F.lit(100.0)


def flagged_value(condition: Column, value: ColumnLike) -> Column:
    """The value where the condition holds, else 0."""
    return F.when(condition, as_col(value)).otherwise(F.lit(0))


def rounded(c: ColumnLike, digits: int = 0, half: str = "up") -> Column:
    if half not in ("up", "even"):
        raise ValueError("half must be 'up' or 'even'")
    return (F.round if half == "up" else F.bround)(as_col(c), digits)


def _log(c: ColumnLike, function) -> Column:
    """Logarithm with the floating-point limits: -Infinity at 0 and NaN below, where the
    built-in functions give null."""
    x = as_col(c).cast("double")
    return (
        F.when(x > 0, function(x)).when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan")))
    )


def natural_log(c: ColumnLike) -> Column:
    return _log(c, F.log)


def log10_axis(c: ColumnLike) -> Column:
    return _log(c, F.log10)


def tick_sequence(lo: float, hi: float, by: float) -> Column:
    """Array lo, lo+by, ... that ends at or before hi."""
    if by <= 0:
        raise ValueError("by must be positive")
    steps = math.floor((hi - lo) / by + 1e-9)
    return F.transform(
        F.sequence(F.lit(0), F.lit(steps)), lambda i: F.lit(lo) + i.cast("double") * F.lit(float(by))
    )


def quadrant(
    x: ColumnLike,
    y: ColumnLike,
    labels: Sequence[str] = ("upper right", "upper left", "lower left", "other"),
) -> Column:
    """Class by the signs of two columns. Comparisons are strict: points on an axis are 'other'."""
    x, y = as_col(x), as_col(y)
    return (
        F.when((x > 0) & (y > 0), F.lit(labels[0]))
        .when((x < 0) & (y > 0), F.lit(labels[1]))
        .when((x < 0) & (y < 0), F.lit(labels[2]))
        .otherwise(F.lit(labels[3]))
    )


# --- activations and shape functions --------------------------------------------------

def sigmoid(c: ColumnLike) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_col(c)))


def relu(c: ColumnLike) -> Column:
    return F.greatest(as_col(c), F.lit(0.0))


def softplus(c: ColumnLike) -> Column:
    """ln(1 + e^x), split so that large x does not overflow."""
    x = as_col(c)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def positive_scale(c: ColumnLike) -> Column:
    """Standard deviation from an unbounded output: 0.001 + softplus(0.05 x)."""
    return F.lit(1e-3) + softplus(F.lit(0.05) * as_col(c))


def asinh(c: ColumnLike) -> Column:
    """Inverse hyperbolic sine by its odd symmetry.

    The built-in function returns -Infinity below about -1e8 and loses digits near 0.
    """
    x = as_col(c)
    a = F.abs(x)
    return F.signum(x) * F.log1p(a + a * a / (F.lit(1.0) + F.sqrt(a * a + F.lit(1.0))))


def log_cosh(c: ColumnLike) -> Column:
    a = F.abs(as_col(c))
    return a + F.log1p(F.exp(F.lit(-2.0) * a)) - F.lit(math.log(2.0))
