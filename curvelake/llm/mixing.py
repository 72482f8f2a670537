"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and some once more: each with probability r - floor(r). Which
ones is decided by the cube method. The vector of probabilities walks through the null space of the balancing constraints (words, documents), so
that both totals stay as they are, until every entry but two at most is 0 or 1 (flight); those are settled with their probabilities kept and
the least expected error (landing). Large documents are decided first, each against many smaller ones, so what is left to land is small.

A source is walked in blocks of bounded size; what blocks leave open, two documents each, meets in the next round, until one block is left.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import BLANK, WORD
from curvelake.operators.windows import number_rows
from curvelake.session import materialize

#: Documents walked by one task together; least number of parts that the sources are dealt to.
BLOCK, PARTS = 16_384, 64

#: Documents that one step of the walk moves against the largest open one.
WINDOW = 256

#: A probability this near to 0 or 1 is decided.
NEAR = 1e-9


def count_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null and empty texts have none. Each becomes one letter, and the letters are counted."""
    bare = F.regexp_replace(F.regexp_replace(text, f"{BLANK}$", ""), f"(?:{BLANK})?+{WORD}+", "x")
    return F.coalesce(F.length(bare), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) with their place and target.

    Weights go to the sources in code-point order, null last, and begin anew when used up. The sources share ``share`` times all sizes by
    weight; a target stops at ``cap`` times its source's size, and what is above goes to the others by weight until none is above:
    each is min(cap * size, level * weight) for one level. An empty table gives no rows; without words all targets are 0.
    """
    if not 0 <= share <= cap:
        raise ValueError("the share cannot be above the cap")
    at = (F.col("place") % len(weights) + 1).cast("int")
    numbered = number_rows(sources.select("source", "source_size"), [F.asc_nulls_last("source")], "place").withColumn("place", F.col("place") - 1)
    weighted = materialize(numbered.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), at)))
    most = F.col("source_size") * F.lit(float(cap))
    level, stopped = 0.0, -1
    while True:
        above = most < F.lit(level) * F.col("weight")
        total, held, open_weight, n = weighted.agg(
            F.sum("source_size"), F.sum(F.when(above, most).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.count_if(above)
        ).first()
        if not total or not open_weight or n == stopped:
            break
        level, stopped = (share * total - held) / open_weight, n
    above = most < F.lit(level) * F.col("weight")
    return weighted.withColumn("target", F.when(above, most).otherwise(F.lit(level) * F.col("weight"))).drop("weight")


def _direction(p: np.ndarray, size: np.ndarray) -> np.ndarray | None:
    """A move of open entries that keeps both sums; the first, the largest, against all others by their room, if sizes allow."""
    room, rest = np.minimum(p, 1 - p)[1:], size[1:]
    u = np.zeros(len(p))
    centre = room @ rest / room.sum()
    spread = room @ (rest - centre) ** 2
    if spread > 1e-9 * max(1.0, centre) ** 2:
        slope = (size[0] - centre) / spread
        u[0], u[1:] = 1.0, -room * (1 / room.sum() + slope * (rest - centre))
    elif size[0] == size[1]:
        u[0], u[1:] = 1.0, -room / room.sum()
    elif len(p) > 2:
        u[1:3] = 1.0, -1.0
    else:
        return None
    return u


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, window: int = WINDOW) -> np.ndarray:
    """Probabilities after the walk: the sums of p and of p * size are kept, and two entries at most are neither 0 nor 1.

    Large entries come first. A step moves one against the ``window`` open ones after it in a direction of the null space, up
    or down with the odds that keep every entry's expectation, as far as the cube reaches: one entry at least is decided.
    """
    p, size = p.astype(float), size.astype(float)
    order = np.argsort(-size, kind="stable")
    order = order[(p[order] > NEAR) & (p[order] < 1 - NEAR)]
    chance = rng.random(len(order) + 1)
    open_, at, turn = order[:0], 0, 0
    while True:
        if len(open_) <= window:
            more = window + 1 - len(open_)
            open_, at = np.concatenate([open_, order[at : at + more]]), at + more
        u = _direction(p[open_], size[open_]) if len(open_) > 1 else None
        if u is None:
            break
        q, moved = p[open_], u != 0
        above, below = (1 - q[moved]) / np.abs(u[moved]), q[moved] / np.abs(u[moved])
        rising = u[moved] > 0
        up, down = np.where(rising, above, below).min(), np.where(rising, below, above).min()
        q = q + (up if chance[turn] * (up + down) < down else -down) * u
        p[open_] = q = np.where(q <= NEAR, 0.0, np.where(q >= 1 - NEAR, 1.0, q))
        open_, turn = open_[(q > 0) & (q < 1)], turn + 1
    return p


def landing(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decides the two open entries at most: each with its probability, jointly with the least expected squared error of words.

    Of all joint laws with these probabilities that is the one where both come as seldom as possible.
    """
    p = p.copy()
    rows = np.flatnonzero((p > 0) & (p < 1))
    chance = rng.random()
    if len(rows) == 1:
        p[rows[0]] = float(chance < p[rows[0]])
    elif len(rows) == 2:
        a, b = p[rows]
        both = max(0.0, a + b - 1)
        first, second = chance < a, chance < both or a <= chance < a + b - both
        p[rows] = float(first), float(second)
    return p


def _walk(units: DataFrame, seed: int, turn: int) -> DataFrame:
    """One round: all units with their probabilities after flight within blocks, and landing where a source is one block."""
    schema = units.schema

    def run(table: pa.Table) -> pa.Table:
        place, block, size, h, p, blocks = (table[c].to_numpy() for c in ("place", "block", "size", "h", "p", "blocks"))
        order = np.lexsort((h, -size, block, place))
        borders = np.flatnonzero((np.diff(place[order]) != 0) | (np.diff(block[order]) != 0)) + 1
        after = p.copy()
        for rows in np.split(order, borders):
            rng = np.random.default_rng([seed, turn, int(place[rows[0]]), int(block[rows[0]])])
            moved = flight(p[rows], size[rows], rng)
            after[rows] = landing(moved, rng) if blocks[rows[0]] == 1 else moved
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(after))

    return units.groupBy("part", "block").applyInArrow(run, schema)


def cube(units: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """``units`` (place of the source, id, size, h, p) with ``p`` 0 or 1: within each source sum(p) and sum(p * size) come as near as landing two
    units allows.

    The draw follows from the seed and the hashes ``h``, whatever the partitioning; units with equal hashes are alike. No unit is decided
    from all units of its source at once: a block has some ``block`` units.
    """
    sizes = units.groupBy("place").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    shape = sizes.agg(F.max("blocks"), F.sum("blocks")).first()
    most, parts = shape[0] or 1, max(PARTS, shape[1] or 1)
    part = F.pmod(F.xxhash64("place"), F.lit(parts)).alias("part")
    units = units.join(sizes, "place").select("*", part, F.pmod(F.xxhash64("h"), F.col("blocks")).alias("block"))
    done, turn = [], 0
    while True:
        walked = materialize(_walk(units, seed, turn))
        if most == 1:
            done.append(walked)
            break
        done.append(walked.where("p IN (0, 1)"))
        # two open units a block at most: many blocks fit into one
        fewer = block // 2
        units = walked.where("p NOT IN (0, 1)").withColumns(
            {"block": F.floor(F.col("block") / fewer), "blocks": F.ceil(F.col("blocks") / fewer)}
        )
        most, turn = -(-most // fewer), turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("part", "block", "blocks")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5, cap: float = 2.0, seed: int = 7, block: int = BLOCK,
) -> DataFrame:
    """Per document: its id, source, size (words), source_size, target (both of its source), copies (times it is taken) and taken (words).

    Every document comes floor or ceil of target / source_size times. Null and empty texts have no words and count as documents only; a
    null source is a source; rows without an id and repeated rows are documents of their own (equal rows are interchangeable); texts are
    counted whole; other columns are not looked at. An empty table gives no rows.
    """
    seen = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"),
    )
    seen = materialize(seen)
    shares = targets(seen.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = materialize(shares.withColumn("ratio", ratio))
    met = seen.join(shares.select(F.col("source").alias("s"), "place", "ratio"), F.col("source").eqNullSafe(F.col("s")))
    units = met.select("place", "id", "size", "h", F.floor("ratio").cast("long").alias("whole"), (F.col("ratio") - F.floor("ratio")).alias("p"))
    drawn = cube(units, seed, block).join(shares.drop("ratio"), "place")
    copies = F.col("whole") + F.col("p").cast("long")
    return drawn.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
