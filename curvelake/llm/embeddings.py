"""Near duplicates of embeddings: spherical k-means cells, blocked cosine products within them, one vector per group kept.

Unit vectors x and y with a cosine of at least t are at most sqrt(2 - 2t) apart. If x lies in cell a and y in cell b, then x and y are
on different sides of the plane between the two centres, and one of them is at most half that far from it. So a vector also visits other
cells whose plane is that near, and linked pairs meet in one of their two cells. In many dimensions that holds for a good part of all cells, so only the
``PROBES`` nearest ones are visited; with ``probes=None`` all of them are, and every pair is found. Either way a link is what the exact cosine says.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from curvelake.llm.components import connected_components
from curvelake.llm.simhash import _merge
from curvelake.session import materialize

#: Vectors in the sample that the centres are fitted on; most centres; vectors a cell should hold.
SAMPLE, CELLS, PER_CELL = 40_000, 2_500, 1_500

#: Other cells that a vector visits. Measured on vectors of 64 components, of pairs with a cosine of just 0.9 such visits find 0.999 in 35 cells, 0.994 in
#: 100 and 0.976 in 512; of pairs at 0.95, 0.996 or more.
PROBES = 8

#: Vectors that live in a cell, and visitors, compared by one task; a larger cell is cut into blocks.
HOMES, GUESTS = 4_096, 32_768

#: Products held at once; cells for vectors of other lengths than most.
AREA, ODD = 1 << 22, 1_024

NODE = "first long, h1 long, h2 long"


def centres(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on unit rows: centres are the unit means of the rows with the largest product."""
    c = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(rounds):
        home = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def unit_rows(v: pd.Series) -> np.ndarray:
    """Vectors of one length as unit rows; scaled by the largest component first, so that no square overflows or vanishes."""
    x = np.stack(v.to_numpy()).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def visits(unit: np.ndarray, c: np.ndarray, reach: float, probes: int | None = PROBES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per row the cell where it lives, and the other cells it visits: those with a plane within half the reach, the nearest ``probes`` of them."""
    product = unit @ c.T
    home = product.argmax(axis=1)
    rows = np.arange(len(unit))
    gap = np.sqrt(np.maximum(0, (c * c).sum(axis=1)[home, None] + (c * c).sum(axis=1) - 2 * (c @ c.T)[home]))
    away = product[rows, home][:, None] - product
    far = away > gap * (reach / 2) + 1e-9
    far[rows, home] = True
    if probes is not None and probes < len(c):
        distance = np.where(far, np.inf, away / np.maximum(gap, 1e-12))
        near = np.argpartition(distance, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(unit), 0), int)
        return home, [np.sort(n[~f]) for n, f in zip(near, np.take_along_axis(far, near, 1))]
    return home, [np.flatnonzero(~f) for f in far]


def link_blocks(
    a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, least: float, skip: Callable[[slice], np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the rows of ``a`` and of ``b``, and for all of them (a, then b) the place of the first row they are connected to.

    Given the same block twice, a row does not link to itself and links are counted for ``a``. ``skip`` marks pairs that meet elsewhere.
    """
    same = a is b
    label = np.arange(len(a) if same else len(a) + len(b))
    ca, cb = np.zeros(len(a)), np.zeros(len(b))
    step = max(16, AREA // max(len(b), 1))
    for at in range(0, len(a), step):
        rows = slice(at, min(at + step, len(a)))
        hit = a[rows] @ b.T >= least
        if skip is not None:
            hit &= ~skip(rows)
        if same:
            hit[np.arange(rows.stop - at), np.arange(at, rows.stop)] = False
        ca[rows] = hit @ wb
        if not same:
            cb += wa[rows] @ hit
        i, j = np.nonzero(hit)
        i, j = i + at, j + (0 if same else len(a))
        if same:
            i, j = i[i < j], j[i < j]
        _merge(label, i, j)
    return ca.astype(np.int64), cb.astype(np.int64), label


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9, probes: int | None = PROBES
) -> DataFrame:
    """One row per input row: the id, n_links (other vectors at a cosine of ``least`` or more), component_id (smallest id
    reachable, itself included) and kept (it is that id).

    Equal vectors are compared as one and counted as many. Vectors that are null, zero, or hold a null or non-finite
    component, and rows without an id, link with nothing: no links, their own id. Vectors of different lengths do not link. Components of any finite
    size are compared in double precision. ``probes=None`` finds every pair, at the price of more copies of the vectors.
    """
    given = vectors.schema[vec_col].dataType
    kept = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType | DoubleType)
    v = F.col(vec_col) if kept else F.col(vec_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    fine = F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(fine, v).alias("v"))
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    usable = rows.where(F.col("v").isNotNull())
    different = materialize(
        usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("m"), F.any_value("v").alias("v"))
    )
    links = materialize(_links(different, least, probes))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(links.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    node = F.struct("first", "h1", "h2").alias("node")
    named = different.select("h1", "h2", "m", node).join(counted, "node", "left").join(groups, "node", "left")
    named = named.select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
        (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce(F.col("component.first"), F.col("node.first")).alias("root"),
    )
    met = rows.select("vec_id", "h1", "h2", F.col("v").isNotNull().alias("usable"))
    met = met.join(named, F.col("usable") & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    component = F.coalesce("root", "vec_id")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _place(different: DataFrame, c: np.ndarray, reach: float, probes: int | None) -> DataFrame:
    """``different`` with ``home``, the cell of each vector, and ``visits``; vectors of another length than the centres live in cells below 0."""
    dim = c.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["v"].map(len).to_numpy()
            for d in np.unique(length):
                part = batch[length == d]
                if d != dim:
                    yield part.assign(home=-1 - int(d) % ODD, visits=[np.zeros(0, int)] * len(part))
                    continue
                for at in range(0, len(part), 1_024):
                    rows = part.iloc[at : at + 1_024]
                    home, to = visits(unit_rows(rows["v"]), c, reach, probes)
                    yield rows.assign(home=home, visits=to)

    kind = different.schema["v"].dataType.simpleString()
    return different.mapInPandas(run, f"{NODE}, m long, v {kind}, home int, visits array<int>")


def _links(different: DataFrame, least: float, probes: int | None) -> DataFrame:
    """(node, links, root): per task the links of a vector, and the first vector that it is connected to there."""
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    total = different.count()
    sample = different.orderBy("h1", "h2").limit(SAMPLE).select("v").toPandas()["v"]
    sizes = sample.map(len)
    dim = int(sizes.mode()[0]) if len(sizes) else 0
    unit = unit_rows(sample[sizes == dim]) if len(sizes) else np.zeros((0, dim))
    k = max(1, min(CELLS, len(unit) // 16, math.ceil(total / PER_CELL)))
    c = centres(unit, k) if len(unit) else np.zeros((1, dim))
    few = probes is not None

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        cell, i, j = key
        length, linked = part["v"].map(len), []
        for d in np.unique(length):
            rows = part[length == d].sort_values(["h1", "h2"])
            guest = rows["guest"].to_numpy(bool)
            second = guest if guest.any() else (rows["block"] == j).to_numpy() if i != j else np.zeros(len(rows), bool)
            a, b = rows[~second], rows[second]
            if not len(a):
                continue
            x, wa, skip = unit_rows(a["v"]), a["m"].to_numpy(float), None
            if i == j and not guest.any():
                b, y, wb = a, x, wa
            elif not len(b):
                continue
            else:
                y, wb = unit_rows(b["v"]), b["m"].to_numpy(float)
            if guest.any():
                # a pair whose two vectors visit each other's cells is counted in the first of them
                back = np.zeros((len(a), max(len(c), 1)), bool)
                for row, to in enumerate(a["visits"]):
                    back[row, to] = True
                of = b["home"].to_numpy()
                skip = lambda s, back=back, of=of: back[s][:, of] & (of < cell)
            ca, cb, label = link_blocks(x, y, wa, wb, least, skip)
            both, count = (a, ca) if b is a else (pd.concat([a, b]), np.concatenate([ca, cb]))
            hit = np.flatnonzero(count)
            to = label[hit]
            out = {n: both[n].to_numpy()[hit] for n in ("first", "h1", "h2")} | {"links": count[hit]}
            linked.append(pd.DataFrame(out | {f"r_{n}": both[n].to_numpy()[to] for n in ("first", "h1", "h2")}))
        none = pd.DataFrame({n: np.zeros(0, np.int64) for n in ("first", "h1", "h2", "links", "r_first", "r_h1", "r_h2")})
        return pd.concat([none, *linked])

    placed = materialize(_place(different, c, reach, probes if few else None))
    blocks = lambda size: F.ceil(F.count("*") / size).cast("int")
    homes = placed.groupBy(F.col("home").alias("cell")).agg(blocks(HOMES).alias("nh"))
    guests = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(blocks(GUESTS).alias("ng"))
    cut = F.broadcast(homes.join(guests, "cell", "left").na.fill(0, ["ng"]))  # CELLS + ODD rows at most
    part = lambda n: F.pmod(F.xxhash64("h2"), F.col(n)).cast("int")
    columns = ("first", "h1", "h2", "m", "v", "home", "visits", "guest", "cell", "block")
    living = placed.withColumns({"cell": F.col("home"), "guest": F.lit(False)}).join(cut, "cell").withColumn("block", part("nh"))
    others = F.explode(F.sequence(F.lit(0), F.col("nh") + F.col("ng") - 1)).alias("o")
    living = living.select(*columns, "nh", others)
    living = living.withColumns({"i": F.when(F.col("o") < F.col("nh"), F.least("block", "o")).otherwise(F.col("block")), "j": F.greatest("block", "o")})
    # only homes travel to every block of visitors, and visitors to the blocks of homes
    coming = placed.withColumn("cell", F.explode("visits")).withColumns({"visits": F.array().cast("array<int>"), "guest": F.lit(True)})
    coming = coming.join(cut, "cell").withColumn("block", part("ng")).withColumn("j", F.col("nh") + F.col("block"))
    coming = coming.select(*columns, "j", F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("i"))
    tasks = living.select(*columns, "i", "j").unionByName(coming.select(*columns, "i", "j"))
    found = tasks.groupBy("cell", "i", "j").applyInPandas(compare, f"{NODE}, links long, r_first long, r_h1 long, r_h2 long")
    return found.select(
        F.struct("first", "h1", "h2").alias("node"), "links",
        F.struct(F.col("r_first").alias("first"), F.col("r_h1").alias("h1"), F.col("r_h2").alias("h2")).alias("root"),
    )
