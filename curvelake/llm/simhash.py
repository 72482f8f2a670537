"""Near duplicates by SimHash fingerprints, linked exactly through a forest of vantage-point trees.

A fingerprint of 64 bits is cut into blocks. If two fingerprints differ in at most ``bound`` bits, they differ in at
most ``bound // blocks`` bits of some block, so one tree per block, under the Hamming distance of that block
alone, finds every link; a small radius keeps the shards' boundaries thin. A tree node holds a vantage value and
a radius. A fingerprint lives on its own side and also asks the other side's shards if its distance is within
the bound of the radius (triangle inequality); all other branches are pruned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from curvelake.llm.components import connected_components
from curvelake.operators.joins import fresh
from curvelake.session import materialize

#: Fingerprints in a sample that places the trees' upper nodes. It steers the work, never the result.
SAMPLE = 65_536

#: Fingerprints that a shard should hold.
SHARD = 4_096

#: A branch this small is compared directly.
DIRECT = 1_024

#: A shard of more than twice this many rows is cut into parts by a hash; each pair of parts is a task of its own.
PART = 32_768


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Fingerprint as a signed 64-bit number; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length).tolist()
    last = ends[width - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(last)
    for at in range(0, n, 65_536):  # bounded memory for texts of any length
        part = [digest(joined[a:b], seed) for a, b in zip(starts[at : at + 65_536], last[at : at + 65_536])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp`` per input row; null texts count as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), _fingerprints(F.col(text_col)).alias("fp"))


def block_masks(blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _distance(values: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((values ^ vantage) & mask).astype(np.int16)


def _split(values: np.ndarray, mask: np.uint64) -> tuple[np.uint64, int] | None:
    """The vantage value, of a few candidates, and the radius that divide the values best."""
    best, found = 0, None
    for v in values[np.linspace(0, len(values) - 1, 5).astype(int)]:
        share = np.cumsum(np.bincount(_distance(values, v, mask), minlength=65))[:-1]
        r = int(np.abs(share - len(values) / 2).argmin())
        size = min(share[r], len(values) - share[r])
        if size > best:
            best, found = size, (v, r)
    return found


def _sides(d_home, d_ask, r: int, near: int):
    """Who goes where: homes inside, homes outside, homes inside that ask outside, askers of either side."""
    inside = d_home <= r
    return inside, ~inside, inside & (d_home > r - near), d_ask <= r + near, d_ask > r - near


def build_tree(sample: np.ndarray, mask: int, depth: int):
    """Nested (vantage, radius, inside, outside); None is a shard."""
    if depth == 0 or len(sample) < 16 or (found := _split(sample, np.uint64(mask))) is None:
        return None
    v, r = found
    d = _distance(sample, v, np.uint64(mask))
    return (int(v), r, build_tree(sample[d <= r], mask, depth - 1), build_tree(sample[d > r], mask, depth - 1))


def route(values: np.ndarray, tree, mask: int, near: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(shard, places of its own values, places of the values that only ask there) of a batch."""
    m = np.uint64(mask)
    todo = [("", tree, np.arange(len(values)), np.arange(0))]
    while todo:
        name, node, home, ask = todo.pop()
        if not len(home) and not len(ask):
            continue
        if node is None:
            yield name, home, ask
            continue
        v, r, inside, outside = node
        hi, ho, cross, ai, ao = _sides(_distance(values[home], np.uint64(v), m), _distance(values[ask], np.uint64(v), m), r, near)
        todo.append((name + "0", inside, home[hi], ask[ai]))
        todo.append((name + "1", outside, home[ho], np.concatenate([home[cross], ask[ao]])))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the sets of i and j, in place; labels are the smallest places of their sets."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = label[label]
            if (above == label).all():
                break
            label[:] = above


def _compare(values, home, ask, bound: int, label) -> None:
    """Unite what links among the homes and between homes and askers, in blocks."""
    for at in range(0, len(home), DIRECT):
        rows = home[at : at + DIRECT]
        others = np.concatenate([home[at:], ask])
        for to in range(0, len(others), DIRECT):
            cols = others[to : to + DIRECT]
            i, j = np.nonzero(np.bitwise_count(values[rows][:, None] ^ values[cols][None, :]) <= bound)
            _merge(label, rows[i], cols[j])


def _flood(values, home, ask, bound: int, label) -> None:
    """The same as :func:`_compare` for many values that no vantage point parts.

    A component grows from one home until nothing links to it; who is in is not compared again, so values within a few
    bits of each other, however many, cost a few passes instead of the square of their number.
    """
    left, is_home = np.concatenate([home, ask]), np.arange(len(home) + len(ask)) < len(home)
    while is_home.any():
        seed = int(is_home.argmax())
        first, todo = left[seed], [(left[seed : seed + 1], True)]
        left, is_home = np.delete(left, seed), np.delete(is_home, seed)
        while todo and len(left):
            rows, from_home = todo.pop()
            if len(rows) > 64:
                todo.append((rows[64:], from_home))
                rows = rows[:64]
            met = np.zeros(len(left), bool)
            for v in values[rows]:
                rest = np.flatnonzero(~met)
                met[rest[np.bitwise_count(values[left[rest]] ^ v) <= bound]] = True
            if not from_home:  # askers do not link to each other here
                met &= is_home
            if met.any():
                new, home_too = left[met], is_home[met]
                _merge(label, np.full(len(new), first), new)
                left, is_home = left[~met], is_home[~met]
                todo += [(part, kind) for part, kind in ((new[~home_too], False), (new[home_too], True)) if len(part)]


def link_shard(values: np.ndarray, is_home: np.ndarray, mask: int, bound: int, near: int) -> np.ndarray:
    """For each value of a shard the place of the first one it is linked to, through any number of links.

    The tree goes on inside the shard down to direct comparisons.
    """
    m, label = np.uint64(mask), np.arange(len(values))
    todo = [(np.flatnonzero(is_home), np.flatnonzero(~is_home))]
    while todo:
        home, ask = todo.pop()
        if not len(home):
            continue
        found = _split(values[home], m) if len(home) > DIRECT else None
        if found is None:
            (_compare if len(home) <= DIRECT else _flood)(values, home, ask, bound, label)
            continue
        v, r = found
        hi, ho, cross, ai, ao = _sides(_distance(values[home], v, m), _distance(values[ask], v, m), r, near)
        todo.append((home[hi], ask[ai]))
        todo.append((home[ho], np.concatenate([home[cross], ask[ao]])))
    return label


def links(fps: DataFrame, bound: int = 4, blocks: int = 3) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to connect all that are within ``bound`` bits.

    ``fps`` has one row per fingerprint, in a column ``fp``. A group of n linked fingerprints gives some
    n links per shard it touches, never all its pairs.
    """
    masks, near = block_masks(blocks), bound // blocks
    n = fps.count()
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp")).limit(min(-(-n // 8), SAMPLE)).collect()], np.int64).view(np.uint64)
    depth = max(2, math.ceil(math.log2(max(n, 1) / SHARD)))
    trees = [build_tree(sample, m, depth) for m in masks]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            for k, (mask, tree) in enumerate(zip(masks, trees)):
                for name, home, ask in route(values.view(np.uint64), tree, mask, near):
                    yield pd.DataFrame(
                        {"shard": f"{k}:{name}", "fp": values[np.concatenate([home, ask])], "home": np.arange(len(home) + len(ask)) < len(home)}
                    )

    def join(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        values = shard["fp"].to_numpy(np.int64)
        mask = masks[int(key[0].split(":")[0])]
        label = link_shard(values.view(np.uint64), shard["home"].to_numpy(bool), mask, bound, near)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": values[moved], "b": values[label[moved]]})

    placed = fps.select("fp").mapInPandas(place, "shard string, fp long, home boolean")
    return cut_shards(placed).groupBy("shard", "pair").applyInPandas(join, "a long, b long")


def cut_shards(placed: DataFrame) -> DataFrame:
    """``placed`` with a column ``pair``; rows of a shard too large for one task go to every pair of parts with their own.

    Any two rows of a shard meet in some pair, so no link is lost.
    """
    placed = materialize(placed)
    large = placed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > 2 * PART)
    large = large.select("shard", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = placed.join(F.broadcast(large), "shard", "left").withColumn("own", own)  # a row per 2 * PART rows at most
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("own"))
    pairs = F.transform(others, lambda p: F.least(p, "own").cast("long") * F.col("parts") + F.greatest(p, "own"))
    alone = F.array(F.lit(0).cast("long"))
    return met.select("shard", "fp", "home", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(pairs)).alias("pair"))


def _roots(prints: DataFrame, bound: int) -> DataFrame:
    """Per different ``fp``: ``root``, the fingerprint that stands for its component, and component_id, the smallest id there."""
    fps = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = connected_components(links(fps, bound)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = fps.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return materialize(rooted.join(least, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 4) -> DataFrame:
    """Per input row: doc_id, ``fp`` and component_id, the smallest id reachable by links of ``bound`` bits or less.

    Copies meet as one fingerprint first. Null or empty texts have the fingerprint 0 and link like any other.
    A row without an id takes part; it gets the smallest id of its component, null if none has one.
    """
    prints = materialize(fingerprints(docs, id_col, text_col))
    return prints.join(_roots(prints, bound), "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 4) -> DataFrame:
    """One input row, all columns, per group of near duplicates: the one with the smallest id.

    A row is known by its id and two hashes of its text, so unrelated rows without an id, or under one repeated id, are
    groups of their own. Of a group's rows with the smallest id one stays; a group whose rows have no id keeps one of them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    x, y, kept, kx, ky = (fresh(n) for n in ("x", "y", "keep", "kx", "ky"))
    marks = {x: F.xxhash64(text), y: F.xxhash64(F.lit(1), text)}
    prints = materialize(docs.select(F.col(id_col).alias("doc_id"), *(c.alias(k) for k, c in marks.items()), _fingerprints(F.col(text_col)).alias("fp")))
    first = prints.join(_roots(prints, bound), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = first.groupBy("root", "doc_id").agg(F.min(F.struct(x, y)).alias("_m"))
    keep = keep.select(F.col("doc_id").alias(kept), F.col("_m")[x].alias(kx), F.col("_m")[y].alias(ky))
    same = F.col(id_col).eqNullSafe(F.col(kept)) & (F.col(x) == F.col(kx)) & (F.col(y) == F.col(ky))
    return docs.withColumns(marks).join(keep, same, "left_semi").dropDuplicates([id_col, x, y]).drop(x, y)
