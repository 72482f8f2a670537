"""Hard negatives, Merkle manifest, mixing: brute-force twins, invariants, odd rows."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from oracle import connect
from pyspark.sql import functions as F

from curvelake.llm import merkle, mixing, negatives, queries

VEC = "vec_id long, embedding array<float>, label int, id long, q string, s int, dim int, n int, a int, r int, p int, t int, rank int"
EXTRA = (1, "q", 2, 3, 4, 5, 6, 7, 8, 9)
DOC = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, rank int, n int, path string, given int, size int, h int, p int, place int, block int, part int, blocks int"
MORE = ("l", 1, 2, 3, "x", 4, 5, 6, 7, 8, 9, 10, 11)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], VEC)


def by_hand(rows, every, k=5):
    """The contract, row by row, with whole numbers."""
    fine = [(i, [math.floor(256 * float(x)) for x in v], y) for i, v, y in rows if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _, _ in fine if i % every == 0}):
        v, y = min(((v, y) for j, v, y in fine if j == i), key=lambda x: (x[1], x[0]))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in fine if j != i and len(w) == len(v))
        for p, j, _ in dict.fromkeys([x for x in scored if x[2] == y][:k]):
            hard = [(m, n) for m, n, z in scored if z != y and -80 * p <= -100 * m <= -100 * p][:k]
            out += [(i, j, r + 1, n, -p, -m) for r, (m, n) in enumerate(hard)]
    return sorted(out)


def test_negatives_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=7).cumsum() * (1 + i % 3))], int(rng.integers(0, 4))) for i in range(300)]
    rows += [(i, rows[7][1], rows[7][2]) for i in range(300, 420)]  # copies of one vector, in one label
    rows += [(420, [0.0] * 7, 0), (421, [1.0, 2.0], 1), (422, [2.0, 1.0], 1), (423, [1.5, 1.0], 0), (440, [1.0, 1.0], 1), (441, [], 1), (460, [], 1)]
    rows += [(500, None, 1), (520, [float("nan")] * 7, 1), (540, [float("inf")] * 7, 0), (560, [None] * 7, 0), (580, [1.0] * 7, None), (None, [1.0] * 7, 1)]
    rows += [rows[20], rows[20], (40, rows[3][1], rows[3][2])]  # repeated rows, a repeated id
    for sizes in ((50, 64, 16), (4_096, 4_096, 512)):
        for name, size in zip(("ANCHORS", "ROWS", "STEP"), sizes):
            monkeypatch.setattr(negatives, name, size)
        got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
        assert sorted(map(tuple, got)) == by_hand(rows, 20)
    assert negatives.mine(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    with pytest.raises(Exception, match="53 bits"):
        negatives.mine(vectors(spark, [(0, [1e30], 1)]), F.lit(True))


def test_summaries_bound_and_prune():
    rng = np.random.default_rng(1)
    a, b = (np.floor(256 * (rng.normal(size=(n, 1)) + rng.normal(size=(n, 64)) * 0.2)) for n in (40, 500))
    exact, sa, sb = a @ b.T, negatives.summaries(a), negatives.summaries(b)
    width = []
    for x, y in zip(sa, sb):
        low, high = negatives.reach(x, y)
        assert (low <= exact).all() and (exact <= high).all()
        flat = negatives._reach_pairs(np.repeat(x, len(b), axis=0), np.tile(y, (len(a), 1)))
        assert np.allclose(flat[0], low.ravel()) and np.allclose(flat[1], high.ravel())
        width.append((high - low).mean())
    assert width == sorted(width, reverse=True)
    least = np.sort(exact, axis=1)[:, -5]
    seen = negatives.surviving_scores(a, sa, b, sb, least, np.full(40, np.inf), np.ones(exact.shape, bool))
    assert np.isfinite(seen).mean() < 0.2  # most pairs are never scored
    assert ((seen == exact) | ~np.isfinite(seen)).all() and np.isfinite(seen[exact >= least[:, None]]).all()


def documents(spark, rows):
    return spark.createDataFrame([(*row, *MORE) for row in rows], DOC)


def odd_rows():
    rows = [(i, f"Text {i} É" * (i % 4), "en", f"s{i % 3}" if i % 7 else None, i) for i in range(700)]
    rows += [(1_000 + i, "One Of many", "de", "big\U0001f600", 5) for i in range(300)]
    rows += [(None, None, None, None, None), (None, "", None, "", 0), (5, "Again", "en", "", 1), (5, "Again", "en", "", 1)]
    rows += [(2_000, "Word " * 40_000, "en", "long", None), (3_000 + 5, "ALONE", "en", "￿", 2)]
    return rows


def tree(nodes):
    """Levels of digests, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_by_hand(rows):
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d, text: sha("".join(map(field, (d[0], d[3], d[2], d[4], text))))
    groups = {}
    for d in rows:
        groups.setdefault(d[3], []).append((d[0] if d[0] is not None else -1, leaf(d, d[1]), d))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(groups[s], key=lambda x: x[:2])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, own, d) in enumerate(sorted(groups[s], key=lambda x: x[:2])):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d[1]) if d[1] is not None else None
            folded = leaf(d, low if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 else d[1])
            sides = ""
            for levels, k in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    run = level[k // 16 * 16 : k // 16 * 16 + 16]
                    before, after = "".join(run[: k % 16]), "".join(run[k % 16 + 1 :])
                    sides, folded, k = sides + before + after, sha(before + folded + after), k // 16
            out.append((d[0], own, trees[s][-1][0], top[-1][0], sha(sides), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("shallow", [4, 1])
def test_manifest_against_brute_force(spark, tmp_path, monkeypatch, shallow):
    monkeypatch.setattr(merkle, "SHALLOW", shallow)
    rows = odd_rows()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, got), key=key) == sorted(manifest_by_hand(rows), key=key)
    by_sql = connect_one(tmp_path).execute(queries.ORACLES["op12_merkle_manifest"]).fetchall()
    assert sorted(by_sql, key=key) == sorted(map(tuple, got), key=key)


def connect_one(path):
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("n", [0, 1])
def test_manifest_of_hardly_any_rows(spark, tmp_path, n):
    documents(spark, odd_rows()[5 : 5 + n]).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert list(map(tuple, got)) == manifest_by_hand(odd_rows()[5 : 5 + n])


def test_proofs_of_some_leaves_and_shared_records(spark):
    docs = documents(spark, odd_rows() + [(9, "same", "en", "twin", 1)] * 40)
    made = merkle.manifest(docs, F.col("source"), F.col("doc_id"), merkle.leaf_digest(F.col("doc_id"), F.col("text")), F.struct("doc_id"))
    asked = made.leaves.where("given.doc_id % 100 = 3")
    proved = merkle.prove(made, asked).withColumn("root", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(proved) == asked.count() > 5 and {r["root"] for r in proved} == {made.root}
    # 40 equal leaves make two equal runs of 16 and one of 8: the runs are stored once
    records = {r["digest"]: r["children"] for r in made.records.collect()}
    assert len(records) == made.records.count()
    assert all(digest == sha("".join(children)) and 1 <= len(children) <= 16 for digest, children in records.items())


def waterfill(sizes, weights=(5, 2, 1)):
    """Excess goes to the others by weight until none is above, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, held = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        level = (goal - sum(held.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return held | {s: level * weight[s] for s in free}
        held |= {s: 2.0 * sizes[s] for s in over}


def test_mix_totals_targets_and_reruns(spark):
    rows = odd_rows() + [(5_000 + i, "w " * (i * i % 97 + 1), "en", f"t{i % 5}", 1) for i in range(2_000)]
    docs = documents(spark, rows)
    got = mixing.mix(docs, block=200).toPandas()
    assert len(got) == len(rows) and got["size"].sum() == sum(len((d[1] or "").split()) for d in rows)
    sums = got.groupby("source", dropna=False).agg(source_size=("source_size", "first"), size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), copies=("copies", "sum"), n=("size", "size"), largest=("size", "max"))
    assert (sums["source_size"] == sums["size"]).all()
    want = waterfill({None if s != s else s: int(n) for s, n in sums["size"].items()})
    for s, row in sums.iterrows():
        assert math.isclose(row["target"], want[None if s != s else s], rel_tol=1e-9, abs_tol=1e-9)
        assert row["n"] < 50 or abs(row["taken"] - row["target"]) <= 20
        assert row["size"] == 0 or abs(row["copies"] - row["n"] * row["target"] / row["size"]) < 2
    assert (got["taken"] == got["copies"] * got["size"]).all() and (got["taken"] <= 2 * got["size"]).all() and (got["taken"] >= 0).all()
    again = mixing.mix(docs.repartition(7), block=200).toPandas()
    order = ["source", "doc_id", "size", "taken"]
    assert got.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))
    other = mixing.mix(docs, seed=8, block=200).toPandas()
    assert not got.sort_values(order)["taken"].reset_index(drop=True).equals(other.sort_values(order)["taken"].reset_index(drop=True))
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None, None, "a", 1), (2, " \n", None, None, 1)])).agg(F.sum("taken"), F.sum("target")).first() == (0, 0.0)


def test_flight_keeps_sums_and_probabilities():
    size = np.array([4000, 300, 20, 20, 20, 7, 5, 3, 900, 1.0] * 6)
    p = np.linspace(0.05, 0.95, len(size))
    drawn = []
    for seed in range(400):
        rng = np.random.default_rng(seed)
        walked = mixing.flight(p, size, rng, window=16)
        assert ((walked > 0) & (walked < 1)).sum() <= 2
        assert math.isclose(walked.sum(), p.sum(), abs_tol=1e-6) and math.isclose(walked @ size, p @ size, rel_tol=1e-9)
        landed = mixing.landing(walked, rng)
        assert set(landed) <= {0.0, 1.0}
        drawn.append(landed)
    assert np.abs(np.mean(drawn, axis=0) - p).max() < 0.12  # four standard errors of 400 draws


def test_what_is_left_to_land_is_small():
    off = []
    for seed in range(100):
        rng = np.random.default_rng(seed)
        size = np.floor(rng.lognormal(5, 1, 200))
        size[seed] = 5_000  # a sixth of what all others have: these can make up for it, taken or not
        p = np.full(200, 0.3 + 0.4 * rng.random())
        off.append(abs(mixing.landing(mixing.flight(p, size, rng), rng) @ size - p @ size))
    assert np.median(off) < 20 and max(off) < 200


def test_count_words_by_definition(spark):
    texts = [None, "", " ", "a", " a", "a ", " a  b\t\n", "é x y", "\x0b", "a\x1cb c", "x\n\ny " * 5_000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.count_words(F.col("t"))).collect()]
    assert got == [0 if t is None else len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]) for t in texts]
