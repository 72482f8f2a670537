import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelake.functions import scalars as s
from curvelake.operators import aggregates, heat, joins, quantiles, sampling, sets, smooth, windows
from curvelake.operators.quantiles import exact_quantiles
from curvelake.plans import growth
from curvelake.session import shared_dir


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


# --- scalars --------------------------------------------------------------------------

def test_scalar_values(spark):
    assert one(spark, s.lenient_double(F.lit("NA"))) is None
    with pytest.raises(Exception):
        one(spark, s.strict_double(F.lit("NA")))
    assert one(spark, s.number_label(F.lit(6.0))) == "6.0" and one(spark, s.whole_label(F.lit(6.0))) == "6"
    assert one(spark, s.first_token(F.lit("  Mazda RX4"))) == "Mazda" and one(spark, s.first_token(F.lit("  "))) is None
    assert one(spark, s.rounded(F.lit(2.5))) == 3.0 and one(spark, s.rounded(F.lit(2.5), 0, "even")) == 2.0
    assert one(spark, s.tick_sequence(10, 36, 4)) == [10, 14, 18, 22, 26, 30, 34]
    assert one(spark, s.tick_sequence(0.0, 1.0, 0.1))[-1] == pytest.approx(1.0)
    assert one(spark, s.percent_label(s.percent_change(F.lit(1.125)), F.lit("Male"))) == "12.50% Male"
    assert one(spark, s.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, s.recode(F.lit(1), {0: "automatic", 1: "manual"})) == "manual"
    assert one(spark, s.natural_log(F.lit(0.0))) == -math.inf and math.isnan(one(spark, s.log10_axis(F.lit(-1.0))))


@pytest.mark.parametrize("x", [-1e9, -100.0, -1e-9, 0.0, 1e-9, 3.0, 1e9])
def test_asinh_keeps_its_digits(spark, x):
    assert one(spark, s.asinh(F.lit(x))) == pytest.approx(math.asinh(x), rel=1e-13)


def test_softplus_and_log_cosh_do_not_overflow(spark):
    assert one(spark, s.softplus(F.lit(1000.0))) == 1000.0
    assert one(spark, s.log_cosh(F.lit(-1000.0))) == pytest.approx(1000 - math.log(2))


def test_quadrant_is_strict(spark):
    points = [(1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0), (1.0, -1.0), (0.0, 1.0)]
    got = [r[0] for r in spark.createDataFrame(points, "x double, y double").select(s.quadrant("x", "y")).collect()]
    assert got == ["upper right", "upper left", "lower left", "other", "other"]


# --- joins ----------------------------------------------------------------------------

def test_group_values_also_for_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 3), (None, 2)], "g string, v int")
    got = sorted((r["g"] or "", r["v"], r["top"]) for r in windows.group_max(df, ["g"], "v", "top").collect())
    assert got == [("", 2, 3), ("", 3, 3), ("a", 1, 5), ("a", 5, 5)]


def test_plans_have_no_cross_product(spark):
    df = spark.range(10).withColumn("g", F.col("id") % 3)
    for out in (
        joins.attach_scalars(df, df, top=F.max("id")),
        joins.repeat_runs(df, 3),
        aggregates.histogram_bins(df, "id", 4),
        exact_quantiles(df, "id", {"m": 0.5}),
        joins.fill_axis(df, "id", ["g"]),
        smooth.kde_grid(df, "id", [0.0, 1.0]),
        aggregates.box_stats(df, "id"),
    ):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fill_axis(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2003, 4.0), ("b", 2001, 2.0)], "g string, y int, v double")
    got = sorted((r["g"], r["y"], r["v"]) for r in joins.fill_axis(df, "y", ["g"]).collect())
    assert len(got) == 8 and got[0] == ("a", 2000, 1.0) and got[1] == ("a", 2001, None) and got[5] == ("b", 2001, 2.0)


def test_ordered_lookup(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    rank = spark.createDataFrame([("c", 1), ("a", 2)], "k string, rank int")
    assert [r["k"] for r in joins.ordered_lookup(df, rank, "k", "rank").collect()] == ["c", "a"]
    assert [r["k"] for r in joins.ordered_lookup(df, rank, "k", "rank", reverse=True).collect()] == ["a", "c"]


# --- aggregates -----------------------------------------------------------------------

def test_null_keys_kept_or_dropped(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert as_dict(aggregates.group_count(df, ["k"]), "k", "count") == {"a": 2, None: 1}
    assert as_dict(aggregates.value_counts(df, "k"), "k", "count") == {"a": 2}


def test_histogram_closes_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 10)], "v double")
    got = [(r["bin_start"], r["bin_end"], r["count"]) for r in aggregates.histogram_bins(df, "v", 5).orderBy("bin").collect()]
    assert got == [(0, 2, 3), (2, 4, 0), (4, 6, 0), (6, 8, 0), (8, 10, 1)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    flat = aggregates.histogram_bins(same, "v", 2).orderBy("bin").collect()
    assert [(r["bin_start"], r["count"]) for r in flat] == [(2.5, 0), (3.0, 2)]
    area = aggregates.density_histogram(df, "v", 5).agg(F.sum(F.col("density") * 2)).first()[0]
    assert area == pytest.approx(1.0)


def test_pivot_refuses_duplicate_cells(spark):
    df = spark.createDataFrame([(2000, "F", 1.0), (2000, "F", 2.0)], "y int, g string, v double")
    with pytest.raises(Exception, match="more than one row"):
        aggregates.pivot_measures(df, "y", "g", ["v"], ["F"]).collect()


def test_pivot_names_and_gaps(spark):
    df = spark.createDataFrame([(2000, "F", 1.0, 5), (2001, "M", 2.0, 6)], "y int, g string, v double, w int")
    wide = aggregates.pivot_measures(df, "y", "g", ["v", "w"]).orderBy("y")
    assert wide.columns == ["y", "v_F", "v_M", "w_F", "w_M"]
    assert [tuple(r) for r in wide.collect()] == [(2000, 1.0, None, 5, None), (2001, None, 2.0, None, 6)]


def test_population_sd(spark):
    row = aggregates.mean_sd(spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double"), ["v"]).first()
    assert row["sd"] == pytest.approx(1.2472191, abs=1e-7)


@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("shape", ["spread", "heavy", "tiny"])
def test_quantiles_equal_brute_force_with_a_hot_group(spark, shape, accuracy):
    rng = random.Random(7)
    values = {
        "spread": lambda: rng.lognormvariate(0, 3),
        "heavy": lambda: float(rng.choice([1, 1, 1, 1, 2, 50])),
        "tiny": lambda: rng.random(),
    }[shape]
    n = 12 if shape == "tiny" else 6000
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), values()) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = {"lo": 0.025, "q": 0.25, "m": 0.5, "hi": 0.975, "top": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"], accuracy).collect()}
    assert set(got) == {g for g, _ in rows}
    for g, r in got.items():
        want = np.quantile([v for k, v in rows if k == g], list(probs.values()))
        assert [r[p] for p in probs] == pytest.approx(list(want), rel=1e-12)
    whole = exact_quantiles(df, "v", probs, (), accuracy).first()
    assert [whole[p] for p in probs] == pytest.approx(list(np.quantile([v for _, v in rows], list(probs.values()))), rel=1e-12)


def test_exact_quantile_fixture(spark):
    row = exact_quantiles(spark.range(10), "id", {"lo": 0.025, "hi": 0.975}).first()
    assert row["lo"] == pytest.approx(0.225) and row["hi"] == pytest.approx(8.775)


def test_box_stats_and_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, 100)], "v double")
    b = aggregates.box_stats(df, "v").first()
    assert (b["q1"], b["median"], b["q3"]) == (2.25, 3.5, 4.75)
    assert (b["whisker_low"], b["whisker_high"], b["outliers"]) == (1.0, 5.0, 1)
    assert [r["v"] for r in aggregates.box_outliers(df, "v").collect()] == [100.0]


# --- windows and sampling -------------------------------------------------------------

def test_index_to_base(spark):
    df = spark.createDataFrame([("g", 2000, 10.0), ("g", 2001, 15.0), ("late", 2001, 4.0)], "g string, y int, v double")
    got = {(r["g"], r["y"]): r["i"] for r in windows.index_to_base(df, "y", "g", "v", "i").collect()}
    assert got == {("g", 2000): 1.0, ("g", 2001): 1.5, ("late", 2001): None}
    own = {(r["g"], r["y"]): r["i"] for r in windows.index_to_base(df, "y", "g", "v", "i", "group").collect()}
    assert own["late", 2001] == 1.0


def test_fractions_sum_to_one(spark):
    df = spark.createDataFrame([("x", "a")] + [("x", "b")] * 3, "x string, f string")
    assert as_dict(windows.group_fraction(df, "x", "f"), "f", "fraction") == {"a": 0.25, "b": 0.75}


def test_row_numbers_are_global_and_gapless(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v")).repartition(9)
    got = as_dict(windows.number_rows(df, ["v"]), "v", "rank")
    assert all(got[v] == v + 1 for v in range(5000))


def test_group_ranks_break_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in "bbaac"], "k string")
    assert as_dict(windows.group_ranks(df, "k"), "k", "rank") == {"a": 1, "b": 2, "c": 3}
    assert as_dict(windows.top_groups(df, "k", 2), "k", "rank") == {"a": 1, "b": 2}


def test_splits_and_shuffles(spark):
    df = spark.range(1000).repartition(5)
    tail = as_dict(sampling.tail_split(df, "id", 0.4), "id", "part")
    assert [k for k, p in tail.items() if p == "validation"] and all((p == "train") == (k < 600) for k, p in tail.items())
    assert as_dict(sampling.tail_split(spark.range(1), "id", 0.4), "id", "part") == {0: "validation"}
    assert as_dict(sampling.tail_split(spark.range(2), "id", 0.4), "id", "part") == {0: "train", 1: "validation"}
    held = sampling.hash_split(df, "id", 0.2, 1).where("part = 'validation'").count()
    assert 150 < held < 250
    a = [r["id"] for r in sampling.seeded_shuffle(df, "id", 1).collect()]
    b = [r["id"] for r in sampling.seeded_shuffle(df.coalesce(1), "id", 1).collect()]
    assert a == b and sorted(a) == list(range(1000)) and a != sorted(a)
    drawn = sampling.bootstrap_batch(df, 1.0, 3)
    assert 850 < drawn.count() < 1150 and drawn.distinct().count() < 750
    assert sampling.bootstrap_batch(df, 5.0, 3).where("id = 0").count() > 0  # the first row can be drawn
    assert sampling.systematic_sample(df, "id", 10).count() == 100


def test_band_outline_order(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0, 2.0), (1, 1.0, 3.0, 5.0)], "i int, x double, lo double, hi double")
    got = [(r["x"], r["y"]) for r in sets.band_outline(df, "i", "x", "lo", "hi").collect()]
    assert got == [(0.0, 1.0), (1.0, 3.0), (1.0, 5.0), (0.0, 2.0)]


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured


# --- smoothers ------------------------------------------------------------------------

def test_line_fixture(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.5), (3.0, 1.0)], "x double, y double")
    r = smooth.group_lm(df, "x", "y").first()
    assert (r["slope"], r["intercept"], r["r2"]) == pytest.approx((-0.5, 3.1666667, 0.1578947), abs=1e-6)


@pytest.mark.parametrize("degree,span", [(1, 0.75), (2, 0.4), (1, 1.0)])
def test_loess_equals_brute_force(spark, degree, span):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 900), np.full(300, 0.5)])  # a quarter of the rows at one value
    y = np.sin(x) + rng.normal(0, 0.1, len(x))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double").repartition(5)
    grid = [-1.5, 0.0, 0.5, 2.0]
    got = as_dict(smooth.loess_grid(df, "x", "y", grid, span, degree, accuracy=200), "grid_x", "fit")
    k = int(math.floor(len(x) * span + 1e-5))
    for g in grid:
        d = np.abs(x - g)
        h = np.sort(d)[k - 1]
        w = np.where(d < h, (1 - np.minimum(d / h, 1) ** 3) ** 3, 0)
        a = np.vander(x - g, degree + 1, increasing=True) * np.sqrt(w)[:, None]
        assert got[g] == pytest.approx(np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0][0], abs=1e-8)


def test_kernel_density_has_area_one_and_binned_is_near(spark):
    df = spark.range(3000).select((F.sin("id") * 10).alias("x"))
    grid = [-20 + 0.25 * i for i in range(161)]
    exact = as_dict(smooth.kde_grid(df, "x", grid, 1.0), "grid_x", "density")
    binned = as_dict(smooth.kde_grid(df, "x", grid, 1.0, bins=500), "grid_x", "density")
    assert sum(exact.values()) * 0.25 == pytest.approx(1, abs=1e-3)
    assert max(abs(exact[g] - binned[g]) for g in grid) < 1e-4


# --- composed -------------------------------------------------------------------------

def test_indexed_growth_by_hand(spark):
    rows = [("F", 2000, 10.0), ("F", 2000, 30.0), ("F", 2001, 30.0), ("M", 2000, 5.0), ("M", 2001, None), ("M", 2001, 6.0)]
    df = spark.createDataFrame(rows, "g string, y int, v double")
    wide = growth.indexed_growth(df, "y", "g", "v").orderBy("y")
    assert wide.columns == ["y", "avg_v_F", "avg_v_M", "v_to_base_F", "v_to_base_M"]
    assert [tuple(r) for r in wide.collect()] == [(2000, 20.0, 5.0, 1.0, 1.0), (2001, 30.0, 6.0, 1.5, 1.2)]
    labels = as_dict(growth.growth_labels(df, "y", "g", "v", names={"F": "Female", "M": "Male"}), "g", "label")
    assert labels == {"F": "50.00% Female", "M": "20.00% Male"}


# --- heat -----------------------------------------------------------------------------

def test_heat_mass_and_reach(spark):
    cells = spark.createDataFrame([(0, 0, 3), (100, 0, 1)], "cx bigint, cy bigint, points bigint")
    surface = heat.heat_surface(cells, 30, 20, 10)
    weights = sum(w for _, _, w in heat.kernel_offsets(30, 20, 10))
    assert surface.agg(F.sum("weight")).first()[0] == pytest.approx(4 * weights)
    at = {(r["cx"], r["cy"]): r["weight"] for r in surface.collect()}
    assert at[3, 0] == 3.0 and at[4, 0] == pytest.approx(1.5) and (5, 0) not in at
    top = heat.heat_opacity(surface).agg(F.min("opacity"), F.max("opacity")).first()
    assert tuple(top) == (0.5, 1.0)


def test_mercator_of_known_points(spark):
    df = spark.createDataFrame([(0.0, 0.0), (85.0511287798066, 180.0)], "lat double, lon double")
    a, b = heat.web_mercator(df, "lat", "lon").collect()
    assert (a["mx"], a["my"]) == pytest.approx((0, 0), abs=1e-6)
    assert (b["mx"], b["my"]) == pytest.approx((20037508.342789, 20037508.342789), abs=1e-2)
    t = heat.tile_pixel(df, "lat", "lon", 1).first()
    assert (t["tile_x"], t["tile_y"], t["px"], t["py"]) == (1, 1, 256, 256)


def test_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("v", F.col("id") * 2)
    runs = [sorted(r["id"] for r in sampling.bootstrap_batch(df.repartition(n), 0.5, 42).collect()) for n in (2, 5)]
    assert runs[0] == runs[1] and 900 < len(runs[0]) < 1100 and len(set(runs[0])) < len(runs[0])


def _numpy_quantiles(rows, probs):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: [float(np.quantile(v, p)) for p in probs] for g, v in groups.items()}


def test_quantiles_of_a_hot_group_and_many_small_ones(spark):
    rng = np.random.default_rng(8)
    rows = [("hot", float(v)) for v in rng.lognormal(0, 3, 30_000)] + [("same", 4.0)] * 5_000
    rows += [(f"g{i % 700}", float(v)) for i, v in enumerate(rng.normal(size=2_000))] + [("none", None), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    probs = {"a": 0.0, "b": 0.001, "c": 0.5, "d": 0.9999, "e": 1.0}
    got = {r["g"]: [r[c] for c in probs] for r in quantiles.exact_quantiles(df, "v", probs, ["g"], 500).collect()}
    want = _numpy_quantiles(rows, probs.values())
    assert set(got) == set(want)
    assert all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)
    at_once = quantiles.exact_quantiles(df, "v", probs).first()
    everything = _numpy_quantiles([(0, v) for _, v in rows], probs.values())[0]
    assert [at_once[c] for c in probs] == pytest.approx(everything, rel=1e-12)


@pytest.mark.parametrize("kind", ["bigint", "int", "float", "decimal(20,4)", "date"])
def test_ranks_of_any_ordered_type(spark, kind):
    df = spark.range(1, 1_001).select((F.col("id") * 7 % 1_001 + (2**53 if kind == "bigint" else 0)).alias("n"))
    v = F.date_add(F.lit("2020-01-01"), F.col("n").cast("int")) if kind == "date" else F.col("n").cast(kind)
    df = df.select(v.alias("v"))
    ranks = (lambda n: F.lit(0), lambda n: n - 1, lambda n: F.floor(n / 2))
    got = quantiles.select_ranks(df, "v", [(0.0, ranks[:1]), (1.0, ranks[1:2]), (0.5, ranks[2:])]).orderBy("t").collect()
    ordered = sorted(r["v"] for r in df.collect())
    assert [r["values"][0] for r in got] == [ordered[0], ordered[-1], ordered[500]]


def test_quantiles_with_nan_infinity_and_no_rows(spark):
    values = [float(i) for i in range(90)] + [float("nan")] * 5 + [float("inf")] * 3 + [float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = [(p, (lambda n, p=p: F.floor((n - 1) * p),)) for p in (0.0, 0.5, 0.92, 0.93, 0.96, 1.0)]
    got = [r["values"][0] for r in quantiles.select_ranks(df, "v", ranks).orderBy("t").collect()]
    ordered = [float("-inf")] + [float(i) for i in range(90)] + [float("inf")] * 3 + [float("nan")] * 5
    want = [ordered[int(98 * p)] for p in (0.0, 0.5, 0.92, 0.93, 0.96, 1.0)]
    assert [str(v) for v in got] == [str(v) for v in want]
    none = df.where(F.lit(False))
    assert quantiles.exact_quantiles(none, "v", {"m": 0.5}).collect() in ([], [(None,)])
    assert quantiles.exact_quantiles(none.withColumn("g", F.lit("a")), "v", {"m": 0.5}, ["g"]).count() == 0


def test_sketches_meet_in_two_stages_and_cuts_follow_the_values(spark):
    df = spark.range(20_000, numPartitions=40).select((F.col("id") * 37 % 20_000).cast("double").alias("v"), F.lit("hot").alias("g"))
    df = df.withColumn("v", F.when(F.col("v") == 19_999, 1e15).otherwise(F.col("v")))  # one far outlier
    table = quantiles.sketches(df, "v", [F.col("g")], [[0.98 + 0.02 * i / quantiles.CUTS for i in range(quantiles.CUTS + 1)]], 500)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("kll_merge_agg") >= 2 and "_part" in plan and plan.count("Exchange hashpartitioning") == 2
    edges = table.first()["_edges"][0]
    inside = [r["v"] for r in df.where(F.col("v") >= edges[0]).collect()]
    held = np.bincount(np.searchsorted(edges, inside, "right"))
    assert edges[-1] == 1e15 and held.max() < 0.2 * len(inside)  # equal widths would put all but one into the first slice
    top = quantiles.exact_quantiles(df, "v", {"m": 1.0, "n": 0.9999}, ["g"]).first()
    assert top["m"] == 1e15 and top["n"] == pytest.approx(np.quantile([*range(19_999), 1e15], 0.9999), rel=1e-12)


def test_kernel_density_by_moments(spark):
    rng = np.random.default_rng(3)
    x = [*map(float, rng.normal(size=500)), 5.0, 5.0, 1e6]  # and one far outlier: most bins in between are empty
    df = spark.createDataFrame([(v,) for v in [*x, None]], "x double")
    grid = [-3.0, -0.5, 0.0, 0.123, 4.9, 1e6]
    for bw in (0.3, 0.01, 50.0, None):
        h = bw if bw is not None else np.std(x, ddof=1) * len(x) ** -0.2
        want = [np.exp(-0.5 * ((g - np.array(x)) / h) ** 2).sum() / (h * len(x) * math.sqrt(2 * math.pi)) for g in grid]
        got = smooth.kde_grid(df, "x", grid, bw)
        assert [r["density"] for r in got.orderBy("grid_id").collect()] == pytest.approx(want, rel=1e-9, abs=1e-11 / h)
    plan = smooth.kde_grid(df, "x", grid)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("generate") < plan.index("sum(pow")  # only bins meet the grid: the explode stands above the sums
    same = smooth.kde_grid(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", [1.0]).collect()
    assert [r["density"] for r in same] in ([], [None])
    assert smooth.kde_grid(df.where("x IS NULL"), "x", grid).count() in (0, len(grid))


def test_growth_reads_its_table_once(spark, tmp_path):
    rows = [("a", 2000, 2.0), ("a", 2001, 4.0), ("b", 2000, 5.0), ("b", 2001, 5.0), ("c", 2001, 1.0)]
    spark.createDataFrame(rows, "g string, year int, v double").write.parquet(str(tmp_path / "t"))
    out = growth.indexed_growth(spark.read.parquet(str(tmp_path / "t")), "year", "g", "v")
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()  # all that is left reads the one aggregate
    got = {r["year"]: (r["v_to_base_a"], r["v_to_base_b"], r["v_to_base_c"]) for r in out.collect()}
    assert got == {2000: (1.0, 1.0, None), 2001: (2.0, 1.0, None)}


def test_heat_pyramid_counts_every_point_at_every_zoom(spark):
    given = [(41.7, -87.8), (41.7, -87.8), (-33.9, 151.2), (90.0, 180.0), (-90.0, -180.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(given, "lat double, lon double")
    got = heat.heat_pyramid(df, "lat", "lon").collect()
    assert {r["zoom"] for r in got} == set(range(19))
    for z in range(19):
        cells = {(r["cx"], r["cy"]): r["points"] for r in got if r["zoom"] == z}
        assert sum(cells.values()) == 5 and all(0 <= c < 2**z for at in cells for c in at)
        assert cells[(2**z - 1, 0)] >= 1 and cells[(0, 2**z - 1)] >= 1  # points off the map count at its border
    assert heat.heat_pyramid(df.limit(0), "lat", "lon").count() == 0
    plain = {(r["cx"], r["cy"], r["points"]) for r in heat.heat_cells(df.limit(3), "lat", "lon", 7, 16).collect()}
    assert plain == {(r["cx"], r["cy"], r["points"]) for r in heat.heat_pyramid(df.limit(3), "lat", "lon", 7, 3, 16).collect() if r["zoom"] == 7}


def test_bootstrap_with_large_fractions(spark):
    drawn = sampling.bootstrap_batch(spark.range(200), 1000.0, 3, "id").groupBy("id").count()
    n, mean, sd = drawn.agg(F.count("*"), F.avg("count"), F.stddev("count")).first()
    assert n == 200 and abs(mean - 1000) < 10 and 25 < sd < 40


def test_quantiles_by_group_do_not_sort_whole_groups(spark):
    """Rows met the sketches by a sort of each group in one task, as Spark had only a guess of the sketches' size."""
    df = spark.range(40_000).select((F.col("id") % 3).alias("g"), F.sin("id").alias("v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = [(0.5, (lambda n: F.floor(n / 2),))]
        plan = quantiles.select_ranks(df, "v", asked, ["g"])._jdf.queryExecution().optimizedPlan().toString()
        sent = quantiles.SENT
        quantiles.SENT = 0
        large = {r["g"]: r["values"] for r in quantiles.select_ranks(df, "v", asked, ["g"]).collect()}
        quantiles.SENT = sent
        small = {r["g"]: r["values"] for r in quantiles.select_ranks(df, "v", asked, ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("strategy=broadcast") >= 2 and large == small and len(small) == 3
