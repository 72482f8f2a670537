"""The random draws written out in SQL."""

from __future__ import annotations


def _mixed(x: str) -> str:
    x = f"xor({x}, {x} >> 16)"
    x = f"(({x} * 569420461) & 4294967295)"
    x = f"xor({x}, {x} >> 15)"
    x = f"(({x} * 1935289751) & 4294967295)"
    return f"xor({x}, {x} >> 15)"


def _fold(keys: tuple[str | int, ...], seed: int, prime: int, times: int, plus: int) -> str:
    h = f"{seed}::BIGINT"
    for k in keys:
        h = f"(({h} * {times} + {plus} + (({k})::BIGINT % {prime} + {prime}) % {prime}) % {prime})"
    return h


def uniform_sql(*keys: str | int, seed: int) -> str:
    """Uniform on (0, 1) from whole-number keys."""
    a = _mixed(_fold(keys, seed, 2147483647, 742938285, 1013904223))
    b = _mixed(_fold(keys, seed, 2147483629, 1583458089, 1442695041))
    return f"((({a} * 1048576 + {b} * 1481765933) & 4503599627370495)::DOUBLE + 0.5) / 4503599627370496"


def normal_sql(*keys: str | int, seed: int) -> str:
    """Standard normal from whole-number keys."""
    return f"sqrt(-2 * ln({uniform_sql(*keys, 0, seed=seed)})) * cos(2 * pi() * {uniform_sql(*keys, 1, seed=seed)})"
