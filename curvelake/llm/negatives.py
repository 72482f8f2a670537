"""Hard negatives by segment summary filtering.

Each vector is stored with the mean and the deviation of its segments, at several levels: the whole vector, then ever shorter
segments. For two vectors the product of a segment's means, times its length, plus or minus the product of its deviations bounds the
segment's part of their inner product; the sum over the segments bounds the score. A pair is bounded level by level, and only pairs that no level rules out
are scored exactly.

Anchors meet all rows in blocks: a task holds one block of anchors and one of rows. Positives are sought among the rows of the same label alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.session import materialize

#: Segments of the levels, coarse to fine; anchors and rows of a block; rows that are bounded at once.
LEVELS, ANCHORS, ROWS, STEP = (1, 4, 16), 4_096, 4_096, 512

#: Counts of so many labels, some 30 bytes each, are broadcast.
FEW = 100_000

#: Whole numbers up to here are doubles without rounding; a vector's squared norm must stay below.
EXACT = 2.0**53

#: The summaries allow for rounding by this share of the norms.
SLACK = 1e-9


def quantise(x: Column) -> Column:
    """floor(256 * x) of every component, as a whole double."""
    return F.transform(x.cast("array<double>"), lambda c: F.floor(c * 256).cast("double"))


def summaries(x: np.ndarray, levels: Sequence[int] = LEVELS) -> list[np.ndarray]:
    """Per level the segments' means, scaled by the root of their length, then the deviations, scaled alike, then the norm."""
    out, norm = [], np.sqrt((x * x).sum(axis=1, keepdims=True))
    for k in levels:
        cuts = np.linspace(0, x.shape[1], min(k, x.shape[1]) + 1).astype(int)
        parts = [x[:, a:b] for a, b in zip(cuts, cuts[1:])]
        root = np.sqrt([p.shape[1] for p in parts])
        mean = np.stack([p.mean(axis=1) for p in parts], axis=1) if parts else x
        spread = np.stack([p.std(axis=1) for p in parts], axis=1) if parts else x
        out.append(np.hstack([mean * root, spread * root, norm]))
    return out


def reach(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores of all rows of ``a`` with all of ``b``, from one level's summaries."""
    k = (a.shape[1] - 1) // 2
    middle = a[:, :k] @ b[:, :k].T
    width = a[:, k : 2 * k] @ b[:, k : 2 * k].T + SLACK * (a[:, -1:] @ b[:, -1:].T)
    return middle - width, middle + width


def _reach_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``reach`` of pairs given row by row."""
    k = (a.shape[1] - 1) // 2
    middle = np.einsum("ij,ij->i", a[:, :k], b[:, :k])
    width = np.einsum("ij,ij->i", a[:, k : 2 * k], b[:, k : 2 * k]) + SLACK * a[:, -1] * b[:, -1]
    return middle - width, middle + width


def surviving_scores(a: np.ndarray, sa: list, b: np.ndarray, sb: list, low: np.ndarray, high: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Scores of the pairs of ``alive`` that may lie within their anchor's [low, high], -inf elsewhere.

    Coarse levels come first; while most pairs survive a level is bounded as a whole, afterwards pair by pair.
    """
    for x, y in zip(sa, sb):
        if alive.sum() * 4 > alive.size:
            least, most = reach(x, y)
            alive = alive & (most >= low[:, None]) & (least <= high[:, None])
        else:
            i, j = np.nonzero(alive)
            least, most = _reach_pairs(x[i], y[j])
            gone = (most < low[i]) | (least > high[i])
            alive = alive.copy()
            alive[i[gone], j[gone]] = False
    if alive.sum() * 4 > alive.size:
        return np.where(alive, a @ b.T, -np.inf)
    out = np.full(alive.shape, -np.inf)
    i, j = np.nonzero(alive)
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[i[s], j[s]] = np.einsum("ij,ij->i", a[i[s]], b[j[s]])
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int, held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The k highest (score, id) per row of what is held and the new scores; columns of equal scores stand in order of ids."""
    scores = scores.copy()
    rows = np.arange(len(scores))
    top, name = [held[0]], [held[1]]
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        top.append(scores[rows, at][:, None])
        name.append(ids[at][:, None])
        scores[rows, at] = -np.inf
    top, name = np.hstack(top), np.hstack(name)
    order = np.lexsort((name, -top), axis=1)[:, :k]
    return np.take_along_axis(top, order, 1), np.take_along_axis(name, order, 1)


def _none(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)


def _steps(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, list, np.ndarray, np.ndarray]]:
    """(vectors, summaries, ids, labels) of parts of a block, in order of ids."""
    rows = rows.sort_values("id", kind="stable")
    for at in range(0, len(rows), STEP):
        part = rows.iloc[at : at + STEP]
        yield np.stack(part["q"]), _levels(part), part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int64)


def _levels(part: pd.DataFrame) -> list[np.ndarray]:
    """The stored summaries, level by level."""
    stored, dim, out, at = np.stack(part["s"]), len(part["q"].iloc[0]), [], 0
    for k in LEVELS:
        width = 2 * min(k, dim) + 1
        out.append(stored[:, at : at + width])
        at += width
    return out


def store(rows: DataFrame) -> DataFrame:
    """``rows`` (id, label, q) with ``s``, the summaries of all levels side by side, and the vector's length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["q"].map(len)):
                yield part.assign(s=list(np.hstack(summaries(np.stack(part["q"])))), dim=len(part["q"].iloc[0]))

    return rows.mapInPandas(run, "id long, label long, q array<double>, s array<double>, dim int")


def _checked(rows: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """id, label and quantised vector of the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    kept = rows.where(fine & label.isNotNull() & F.col(id_col).isNotNull())
    q = quantise(F.col(vec_col))
    # floating point adds these products without rounding
    small = F.aggregate(q, F.lit(0.0), lambda t, c: t + c * c) < EXACT
    q = F.when(small, q).otherwise(F.raise_error(F.lit("a score may not fit into 53 bits")).cast("array<double>"))
    return kept.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), q.alias("q"))


def _met(anchors: DataFrame, rows: DataFrame, by: list[str]):
    """Blocks of anchors and of rows with the same values of ``by``, each pair a task.

    The number of blocks follows from the counts, so a label with a third of all rows is cut like all others.
    """
    met = []
    for side, size in ((anchors, ANCHORS), (rows, ROWS)):
        met.append(side.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("n")))
    na, nr = (m.withColumnRenamed("n", f"n{i}") for i, m in enumerate(met))
    counts = materialize(na.join(nr, by))
    counts = F.broadcast(counts) if counts.count() <= FEW else counts
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = anchors.join(counts, by).withColumn("a", own("n0")).withColumn("r", others("n1")).drop("n0", "n1")
    r = rows.join(counts, by).withColumn("r", own("n1")).withColumn("a", others("n0")).drop("n0", "n1")
    a = a.select(*(F.col(c).alias(c) for c in a.columns))  # both sides come from the same rows: new names for the cogroup
    keys = [*by, "a", "r"]
    return a.groupBy(*keys).cogroup(r.groupBy(*keys))


def positives(anchors: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """(anchor_id, positive_id, positive_score): per anchor the k best other rows of its label."""

    def search(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(r):
            x, sa, ids = np.stack(a["q"]), _levels(a), a["id"].to_numpy(np.int64)
            held = _none(len(a), k)
            for y, sb, names, _ in _steps(r):
                low = np.maximum(held[0][:, -1], -EXACT)  # a score as high may win by its id
                alive = ids[:, None] != names[None, :]
                held = best(surviving_scores(x, sa, y, sb, low, np.full(len(a), EXACT), alive), names, k, held)
            i, j = np.nonzero(np.isfinite(held[0]))
            out.append(pd.DataFrame({"anchor_id": ids[i], "positive_id": held[1][i, j], "positive_score": held[0][i, j].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []}, dtype="int64")

    found = _met(anchors, rows, ["label", "dim"]).applyInPandas(search, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def negatives(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, k: int = 5, lowest: int = 80, highest: int = 100) -> DataFrame:
    """Per anchor and positive of ``pairs`` the k best rows of other labels with
    lowest * positive_score <= 100 * negative_score <= highest * positive_score, ranked from 1."""
    asked = pairs.distinct().groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("p"))  # a few each
    met = anchors.join(asked, F.col("id") == F.col("anchor_id")).select(
        "id", "label", "dim", "q", "s", F.col("p.positive_id").alias("p"), F.col("p.positive_score").alias("t")
    )

    def search(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        columns = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})]
        if len(a) and len(r):
            x, sa, ids, label = np.stack(a["q"]), _levels(a), a["id"].to_numpy(np.int64), a["label"].to_numpy(np.int64)
            width = a["t"].map(len).max()
            score, name = np.full((len(a), width), -1, np.int64), np.zeros((len(a), width), np.int64)
            for i, (t, p) in enumerate(zip(a["t"], a["p"])):
                score[i, : len(t)], name[i, : len(t)] = t, p
            # least and greatest whole score of each window; those of negative positives are empty
            least, most = -((-lowest * score) // 100), highest * score // 100
            open_ = (score >= 0) & (least <= most)
            held = [_none(len(a), k) for _ in range(width)]
            for y, sb, names, others in _steps(r):
                need = np.stack([np.maximum(least[:, j], held[j][0][:, -1]) for j in range(width)], axis=1)
                low = np.where(open_, need, EXACT).min(axis=1)
                high = np.where(open_, most, -EXACT).max(axis=1)
                s = surviving_scores(x, sa, y, sb, low, high, label[:, None] != others[None, :])
                for j in range(width):
                    inside = open_[:, j, None] & (s >= need[:, j, None]) & (s <= most[:, j, None])
                    hit = np.flatnonzero(inside.any(axis=1))
                    if len(hit):
                        new = best(np.where(inside[hit], s[hit], -np.inf), names, k, (held[j][0][hit], held[j][1][hit]))
                        held[j][0][hit], held[j][1][hit] = new
            for j in range(width):
                i, c = np.nonzero(np.isfinite(held[j][0]))
                values = (ids[i], name[i, j], held[j][1][i, c], score[i, j], held[j][0][i, c].astype(np.int64))
                out.append(pd.DataFrame(dict(zip(columns, values))))
        return pd.concat(out)

    found = _met(met, rows, ["dim"]).applyInPandas(
        search, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    )
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None, k: int = 5,
    lowest: int = 80, highest: int = 100,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, rows for which ``anchor`` holds.

    Scores are whole: inner products of vectors in steps of 1/256. Higher ones come first, smaller ids first among equals. Rows without an id or label,
    with a null vector or a component that is null or not finite take no part; vectors of different
    lengths do not meet. Rows of one id are one anchor, the one with the least label and vector, but each can be found; a positive found
    twice with one score is listed once. Other columns are not looked at. An empty table gives no rows. Vectors so long that a score might not fit into 53 bits (a norm above some 370,000) are an error.
    """
    label = F.col("label") if label is None else label
    rows = materialize(store(_checked(vectors, id_col, vec_col, label)))
    chosen = vectors.where(anchor & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    first = rows.join(chosen, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "q", "s", "dim")).alias("row"))
    anchors = materialize(first.select("id", "row.*"))
    pairs = materialize(positives(anchors, rows, k))
    out = negatives(anchors, rows, pairs, k, lowest, highest)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
