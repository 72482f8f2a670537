"""Merkle manifest of a dataset: a content-addressed store of digest-to-children records, and proofs by descent through it.

The rows of a group are its leaves, in order of a key. Every run of ``FAN`` consecutive nodes becomes one node, level by level, until one is
left: the group's subroot. The subroots, in order of their groups, are joined to the root in the same way. A node is stored once under its
digest, with the digests of its children; nothing else holds the tree together.

A proof is found from the root downwards: the digits of a leaf's rank, in base ``FAN``, say which child to follow; the children
not followed are the siblings. Reversed, they lead from the leaf up to the root.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.operators.windows import number_rows
from curvelake.session import materialize

#: Children of a node: 2 ** BITS.
BITS = 4
FAN = 1 << BITS

#: Records less than this many steps below the root are broadcast: FAN ** 3 records at most.
SHALLOW = 4

EMPTY_PATH = "array<struct<before:string,after:string>>"


class Manifest(NamedTuple):
    """``leaves``: one row per leaf (tree, rank, n, leaf, given); ``records``: digest, children; ``root``: a digest, None without leaves."""

    leaves: DataFrame
    records: DataFrame
    root: str | None
    trees: int
    largest: int


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, side by side."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row: of its fields one after another. Nulls and empty values differ; a text of any length is hashed whole."""
    return digest(*(field(c) for c in columns))


def height(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _height(n: Column) -> Column:
    """``height`` of a column, for up to FAN ** 15 leaves."""
    return sum((F.when(n > FAN**k, 1).otherwise(0) for k in range(15)), F.lit(0))


def _digits(number: Column, length: Column) -> Column:
    """Digits of a number, highest first."""
    places = F.filter(F.sequence(F.lit(15), F.lit(0)), lambda i: i < length)
    return F.transform(places, lambda i: F.floor(number / F.pow(F.lit(float(FAN)), i)).cast("long") % FAN)


def _place(rows: DataFrame) -> DataFrame:
    """tree (place of the group among the groups), rank (of the leaf in its group) and n (leaves of the group), all from 0.

    One distributed sort, written with each row's place in its partition; counts per partition and group are then summed up in order, so
    a group of any size is never gathered. Groups without a name come first, then by code point; leaves by key, null
    first, then by digest.
    """
    order = [F.asc_nulls_first("grp"), F.asc_nulls_first("key"), F.asc("leaf")]
    placed = materialize(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33).alias("part")
    cuts = materialize(placed.groupBy(part, "grp").agg(F.min("place").alias("first"), F.count("*").alias("rows")))
    trees = number_rows(cuts.groupBy("grp").agg(F.min("first").alias("first"), F.sum("rows").alias("n")), ["first"], "tree")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = cuts.withColumn("ahead", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    named = starts.alias("s").join(trees.alias("t"), F.col("s.grp").eqNullSafe(F.col("t.grp")))
    named = named.select("s.part", F.col("s.grp").alias("g"), "s.first", "ahead", "t.n", (F.col("tree") - 1).alias("tree"))
    met = placed.withColumn("p", part).join(named, (F.col("p") == F.col("part")) & F.col("grp").eqNullSafe(F.col("g")))
    return met.select("tree", (F.col("place") - F.col("first") + F.col("ahead")).alias("rank"), "n", "leaf", "given")


def _grow(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of all levels over ``nodes`` (tree, rank, n, digest), and the last node of each tree."""
    records, tops = [], [nodes.where("n = 1")]
    for _ in range(levels):
        runs = nodes.where("n > 1").groupBy("tree", F.shiftright("rank", BITS).alias("rank"))
        grown = runs.agg(F.ceil(F.max("n") / FAN).alias("n"), F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"))  # FAN at most
        grown = grown.select("tree", "rank", "n", F.col("run.digest").alias("children"))
        nodes = materialize(grown.withColumn("digest", digest(F.concat_ws("", "children"))))
        records.append(nodes.select("digest", "children"))
        tops.append(nodes.where("n = 1"))
    same = [t.select("tree", "digest") for t in tops]
    top = same[0]
    for t in same[1:]:
        top = top.unionByName(t)
    return records, top


def manifest(rows: DataFrame, group: Column, key: Column, leaf: Column, given: Column) -> Manifest:
    """The manifest of ``rows``: ``leaf`` is a row's digest, ``given`` what its leaf carries along (a struct keeps any columns, whatever their names).

    Rows without a group are one group, the first; rows without a key come first in theirs. Repeated rows are leaves of their own;
    equal subtrees are stored once. An empty table has no records and no root.
    """
    rows = materialize(rows.select(group.alias("grp"), key.alias("key"), leaf.alias("leaf"), given.alias("given")))
    leaves = materialize(_place(rows))
    sizes = leaves.agg(F.max("n"), F.max("tree")).first()
    if sizes[0] is None:
        return Manifest(leaves, leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children")), None, 0, 0)
    largest, trees = sizes[0], sizes[1] + 1
    lower, tops = _grow(leaves.withColumnRenamed("leaf", "digest").drop("given"), height(largest))
    subroots = materialize(tops.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), F.lit(trees).alias("n"), "digest"))
    upper, top = _grow(subroots, height(trees))
    records = [*lower, *upper] or [leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children")).where(F.lit(False))]
    store = records[0]
    for more in records[1:]:
        store = store.unionByName(more)
    return Manifest(leaves, materialize(store.dropDuplicates(["digest"])), top.first()["digest"], trees, largest)


def _sides(children: Column, at: Column) -> Column:
    """The siblings left and right of a child."""
    left, right = F.slice(children, F.lit(1), at.cast("int")), F.slice(children, at.cast("int") + 2, F.lit(FAN))
    return F.struct(F.concat_ws("", left).alias("before"), F.concat_ws("", right).alias("after"))


def _shallow(m: Manifest, spark) -> list[DataFrame]:
    """Records of the steps below ``SHALLOW``: FAN ** step at most, as each comes from the children of the one before."""
    front, out = spark.createDataFrame([(m.root,)], "digest string"), []
    for _ in range(SHALLOW):
        out.append(materialize(m.records.join(F.broadcast(front), "digest", "left_semi")))
        front = out[-1].select(F.explode("children").alias("digest")).distinct()
    return out


def prove(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per request its leaf, the subroot, what the leaf carries, and ``path``: the siblings (before, after) from leaf to root.

    ``requests`` are rows of ``m.leaves``, each once; by default all. Requests of one run go down together. Near the root, where many follow
    one record, the records are broadcast (their number is bounded); further down no record leads to more than a small part of the requests.
    """
    requests = m.leaves if requests is None else requests
    runs = requests.select("tree", "n", F.shiftright("rank", BITS).alias("run"), F.struct((F.col("rank") % FAN).alias("digit"), "leaf", "given").alias("l"))
    runs = materialize(runs.groupBy("tree", "run").agg(F.max("n").alias("n"), F.collect_list("l").alias("asked")))  # FAN at most
    if m.root is None:
        return runs.select(F.explode("asked").alias("l")).select(
            "l.leaf", F.col("l.leaf").alias("subroot"), "l.given", F.array().cast(EMPTY_PATH).alias("path")
        )
    above, shallow = height(m.trees), _shallow(m, requests.sparkSession)
    levels = _height(F.col("n"))
    upper = _digits(F.col("tree"), F.lit(above))
    state = runs.select(
        "tree", "run", (levels == 0).alias("lone"), F.concat(upper, _digits(F.col("run"), levels - 1)).alias("digits"),
        F.lit(m.root).alias("digest"), F.lit(m.root).alias("subroot"), F.array().cast(EMPTY_PATH).alias("path"),
    )
    ended = []
    for step in range(above + max(height(m.largest), 1)):
        # a group of one leaf ends at its subroot; the others at the record of their run, whose children are leaves
        if step == above:
            lone = state.where("lone").withColumn("children", F.array("digest"))
            ended.append(lone.select("tree", "run", "lone", "subroot", "children", "path"))
            state = state.where("NOT lone")
        if step == 0:  # all are at the root: its children are a value
            top = shallow[0].first()
            met = state.withColumn("children", F.array(*(F.lit(c) for c in top["children"]))) if top else state.withColumn("children", F.array("digest"))
        else:
            met = state.join(F.broadcast(shallow[step]) if step < SHALLOW else m.records, "digest")
        met = materialize(met)
        ended.append(met.where(F.size("digits") == step).select("tree", "run", "lone", "subroot", "children", "path"))
        at = F.element_at("digits", step + 1)
        child = F.element_at("children", at.cast("int") + 1)
        state = met.where(F.size("digits") > step).select(
            "tree", "run", "lone", "digits", child.alias("digest"), (child if step < above else F.col("subroot")).alias("subroot"),
            F.concat("path", F.array(_sides(F.col("children"), at))).alias("path"),
        )
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    found = found.withColumn("path", F.reverse("path"))
    each = found.join(runs.select("tree", "run", "asked"), ["tree", "run"]).withColumn("l", F.explode("asked"))
    own = F.when(F.col("lone"), F.array().cast(EMPTY_PATH)).otherwise(F.array(_sides(F.col("children"), F.col("l.digit"))))
    return each.select("l.leaf", "subroot", "l.given", F.concat(own, "path").alias("path"))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, from leaf to root, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda at, s: digest(s["before"], at, s["after"]))
