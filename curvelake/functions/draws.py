"""Random numbers as functions of whole-number keys.

A draw depends only on the keys and the seed. It is the same whatever the partitioning, and a task that runs again
after a lost executor repeats its values. All steps are whole-number arithmetic below 2^63, so SQL can repeat every draw:
the keys are folded modulo two primes, each remainder goes through a 32-bit mixer, and 52 bits of both make the number.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .scalars import ColumnLike, as_col, quoted

# Prime, multiplier and increment of each fold. The primes are the largest two below 2^31, so keys
# that agree in both remainders are at least 2^61 apart.
FOLDS = ((2147483647, 742938285, 1013904223), (2147483629, 1583458089, 1442695041))
# Shifts and multipliers of a public-domain 32-bit mixer (xorshift and multiply).
SHIFTS, FACTORS = (16, 15, 15), (0x21F0AAAD, 0x735A2D97)
# Fixed value: spreads the second remainder over all 52 bits.
SPREAD = 1481765933


def whole(df: DataFrame, key: str) -> Column:
    """A column as key of draws: whole numbers as they are (null: -1), other types by a 64-bit hash."""
    c = F.col(quoted(key))
    kind = df.select(c).schema[0].dataType
    return F.coalesce(c.cast("bigint"), F.lit(-1).cast("bigint")) if isinstance(kind, IntegralType) else F.xxhash64(c)


def _mixed(x):
    """The mixer on Columns of whole numbers from 0 to 2^32 - 1."""
    for shift, factor in zip(SHIFTS, (*FACTORS, None)):
        x = x.bitwiseXOR(F.shiftright(x, shift))
        if factor:
            x = (x * F.lit(factor).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF))
    return x


def uniform(*keys: ColumnLike, seed: int = 0) -> Column:
    """Uniform on the open interval (0, 1). Keys are whole numbers; a null key gives null."""
    whole_keys = [as_col(k).cast("bigint") for k in keys]
    parts = []
    for prime, times, plus in FOLDS:
        h = F.lit(seed % prime).cast("bigint")
        for k in whole_keys:
            h = F.pmod(h * F.lit(times).cast("bigint") + F.lit(plus).cast("bigint") + F.pmod(k, F.lit(prime).cast("bigint")), F.lit(prime).cast("bigint"))
        parts.append(_mixed(h))
    bits = (parts[0] * F.lit(1 << 20) + parts[1] * F.lit(SPREAD).cast("bigint")).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-52)


def uniform_array(*keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """The numbers of ``uniform`` for arrays of keys (which broadcast against each other)."""
    parts = []
    for prime, times, plus in FOLDS:
        h = np.int64(seed % prime)
        for k in keys:
            h = (h * np.int64(times) + np.int64(plus) + np.mod(np.asarray(k, np.int64), np.int64(prime))) % np.int64(prime)
        for shift, factor in zip(SHIFTS, (*FACTORS, None)):
            h = h ^ (h >> np.int64(shift))
            if factor:
                h = (h * np.int64(factor)) & np.int64(0xFFFFFFFF)
        parts.append(h)
    bits = (parts[0] * np.int64(1 << 20) + parts[1] * np.int64(SPREAD)) & np.int64((1 << 52) - 1)
    return (bits.astype(float) + 0.5) * 2.0**-52


def normal(*keys: ColumnLike, seed: int = 0) -> Column:
    """Standard normal by the Box-Muller map of two uniforms."""
    u1 = uniform(*keys, F.lit(0), seed=seed)
    u2 = uniform(*keys, F.lit(1), seed=seed)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
