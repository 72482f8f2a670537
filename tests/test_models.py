import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelake.functions import likelihood as lk
from curvelake.models import coupling, flows, nets, predictive
from curvelake.models import regression as m
from curvelake.sources import generators


def coefs(df):
    return [r["value"] for r in df.where("term >= 0").orderBy("term").collect()]


@pytest.fixture(scope="module")
def sine(spark):
    df = generators.sine_data(spark, 100, 1.0, 11).cache()
    rows = df.orderBy("id").collect()
    return df, np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])


def design(x, degree):
    return np.vander(x, degree + 1, increasing=True)


# --- closed forms ---------------------------------------------------------------------

def test_polynomial_recovery(spark):
    assert coefs(m.fit_ols(generators.polynomial_data(spark), "x", "y", 3)) == pytest.approx([5, 10, -3, 6], abs=1e-8)


@pytest.mark.parametrize("degree", [1, 3, 9])
def test_ols_predictions_equal_least_squares(sine, degree):
    df, x, y = sine
    got = np.array([r["yhat"] for r in m.predict(df, m.fit_ols(df, "x", "y", degree), "x").orderBy("id").collect()])
    t = np.polynomial.chebyshev.chebvander((x - np.pi) / np.pi, degree)
    want = t @ np.linalg.lstsq(t, y, rcond=None)[0]
    assert got == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("degree,alpha", [(3, 0.5), (9, 0.5)])
def test_ridge_minimises_its_objective(sine, degree, alpha):
    df, x, y = sine
    w = np.array(coefs(m.fit_ridge(df, "x", "y", degree, alpha)))
    a = np.vstack([design(x, degree), math.sqrt(alpha) * np.eye(degree + 1)[1:]])
    target = np.concatenate([y, np.zeros(degree)])
    size = np.linalg.norm(a, axis=0)
    best = np.linalg.lstsq(a / size, target, rcond=None)[0] / size
    loss = lambda v: np.sum((a @ v - target) ** 2)
    assert loss(w) == pytest.approx(loss(best), rel=1e-6)


def test_ridge_without_penalty_is_ols(sine):
    df, _, _ = sine
    assert coefs(m.fit_ridge(df, "x", "y", 3, 0.0)) == pytest.approx(coefs(m.fit_ols(df, "x", "y", 3)), rel=1e-6)


@pytest.mark.parametrize("degree,alpha", [(1, 0.2), (2, 0.3), (3, 0.1), (9, 0.01), (9, 0.3)])
def test_lasso_meets_the_optimality_conditions(sine, degree, alpha):
    df, x, y = sine
    b, *w = coefs(m.fit_lasso(df, "x", "y", degree, alpha))
    w, powers = np.array(w), design(x, degree)[:, 1:]
    residual = y - b - powers @ w
    pull = powers.T @ residual / len(x)
    assert residual.mean() == pytest.approx(0, abs=1e-8)
    for j in range(degree):
        if abs(w[j]) > 1e-12:
            assert pull[j] == pytest.approx(alpha * np.sign(w[j]), abs=1e-5)
        else:
            assert abs(pull[j]) <= alpha + 1e-5


def test_sparse_minimum_beats_coordinate_descent():
    rng = np.random.default_rng(5)
    for m_ in (2, 4, 7):
        for _ in range(20):
            a = rng.normal(size=(40, m_))
            cov, pull, cost = a.T @ a / 40, rng.normal(size=m_), rng.uniform(0.05, 0.8, m_)
            got, w = m._sparse_minimum(cov, pull, cost), np.zeros(m_)
            for _ in range(3000):
                for j in range(m_):
                    z = pull[j] - cov[j] @ w + cov[j, j] * w[j]
                    w[j] = np.sign(z) * max(abs(z) - cost[j], 0) / cov[j, j]
            assert got == pytest.approx(w, abs=1e-7)


def test_fit_many_equals_single_fits_and_stays_distributed(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") % 17).cast("double").alias("x"),
        (F.sin("id") + F.col("id") % 17).alias("y"),
    )
    many = m.fit_many(df, "x", "y", {"a": ("linear", 2, 0.0), "b": ("ridge", 1, 2.0)}, "g").where("group = 'hot'")
    hot = df.where("g = 'hot'")
    assert coefs(many.where("model = 'a'")) == pytest.approx(coefs(m.fit_ols(hot, "x", "y", 2)), rel=1e-8)
    assert coefs(many.where("model = 'b'")) == pytest.approx(coefs(m.fit_ridge(hot, "x", "y", 1, 2.0)), rel=1e-8)


def test_standardize_with_training_stats(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    grid = spark.createDataFrame([(7.0,)], "x double")
    got = m.standardize(grid, ["x"], m.feature_stats(train, ["x"])).first()["x"]
    assert got == pytest.approx((7 - 7 / 3) / 1.2472191, abs=1e-6)


# --- iterative ------------------------------------------------------------------------

def test_gradient_descent_reaches_ols(sine):
    df, x, y = sine
    z = m.standardize(df.withColumns({"x2": F.col("x") ** 2, "x3": F.col("x") ** 3}), ["x", "x2", "x3"])
    w, history = m.fit_gradient(z, ["x", "x2", "x3"], "y", {"kind": "constant", "rate": 0.2}, 60000)
    best = coefs(m.fit_gaussian(z, ["x", "x2", "x3"], "y"))
    assert coefs(w) == pytest.approx(best, abs=1e-3)
    losses = [r["loss"] for r in history.orderBy("step").collect()]
    assert losses[-1] < losses[0] and all(a >= b - 1e-12 for a, b in zip(losses, losses[1:]))


def test_early_stop(spark):
    losses = [5.0, 4.0, 4.5, 4.6, 3.0, 3.1, 3.2, 3.3, 1.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(losses)], "model string, step int, loss double")
    r = m.early_stop(df, patience=3).first()
    assert (r["best_step"], r["best_loss"], r["stop_step"]) == (4, 3.0, 7)
    r = m.early_stop(df, patience=20).first()
    assert (r["best_step"], r["best_loss"], r["stop_step"]) == (8, 1.0, 8)


@pytest.mark.parametrize(
    "schedule",
    [
        {"kind": "constant", "rate": 0.1},
        {"kind": "table"},
        {"kind": "exponential", "rate": 0.4, "decay": 0.96, "steps": 1000},
        {"kind": "exponential", "rate": 0.4, "decay": 0.96, "steps": 1000, "floored": True},
    ],
)
def test_learning_rate_column_equals_loop(spark, schedule):
    got = [tuple(r) for r in spark.range(0, 20000, 37).select("id", lk.learning_rate("id", schedule)).collect()]
    assert all(rate == pytest.approx(lk.rate_at(step, schedule), rel=1e-12) for step, rate in got)


def test_likelihoods_agree(spark):
    df = spark.range(50).select((F.sin("id") * 3).alias("y"), F.cos("id").alias("mu"))
    constant = df.agg(F.sum(lk.normal_nll("y", "mu", F.lit(math.log(3.0))))).first()[0]
    want = sum(0.5 * math.log(2 * math.pi) + math.log(3) + (3 * math.sin(i) - math.cos(i)) ** 2 / 18 for i in range(50))
    assert constant == pytest.approx(want)
    assert df.agg(F.sum(lk.linked_nll("y", "mu", F.lit(math.log(3.0)), "exp"))).first()[0] == pytest.approx(want)


def test_gaussian_fit_equals_ols(sine):
    df, x, y = sine
    fit = m.fit_gaussian(df, ["x"], "y")
    assert coefs(fit) == pytest.approx(coefs(m.fit_ols(df, "x", "y", 1)), rel=1e-8)
    residual = y - design(x, 1) @ coefs(fit)
    assert fit.where("term = -1").first()["value"] == pytest.approx(math.sqrt(np.mean(residual**2)))


def test_hetero_fit_recovers_its_model(spark):
    from curvelake.functions import draws

    df = spark.range(20000).withColumn("x", F.col("id") / 10000 - 1).withColumn(
        "y", 1 + 2 * F.col("x") + F.exp(-0.5 + 0.8 * F.col("x")) * draws.normal("id", seed=5)
    )
    fit, history = m.fit_hetero(df, ["x"], ["x"], "y", 12)
    assert coefs(fit.where("model = 'hetero_mean'")) == pytest.approx([1, 2], abs=0.03)
    assert coefs(fit.where("model = 'hetero_log_sigma'")) == pytest.approx([-0.5, 0.8], abs=0.03)
    losses = [r["loss"] for r in history.orderBy("step").collect()]
    assert min(losses) < losses[0]


# --- draws ----------------------------------------------------------------------------

def test_predictive_band_of_constant_sigma(spark):
    grid = generators.linspace(spark, 0, 1, 5).withColumns({"mu": F.col("x") * 2, "sigma": F.lit(0.5)})
    band = predictive.draw_summary(predictive.predictive_draws(grid, "grid_id", "mu", "sigma", 20000, 3), ["grid_id", "mu"])
    for r in band.collect():
        assert r["mean"] == pytest.approx(r["mu"], abs=0.02)
        assert r["lower"] == pytest.approx(r["mu"] - 0.98, abs=0.05) and r["upper"] == pytest.approx(r["mu"] + 0.98, abs=0.05)


def test_weight_draws_share_weights_within_a_run(spark):
    grid = generators.linspace(spark, 0, 2, 3)
    drawn = predictive.weight_draws(grid, ["x"], [1.0, 2.0], [0.1, 0.2], 4000, 1)
    wide = drawn.groupBy("run").pivot("grid_id", [0, 1, 2]).agg(F.first("y_draw"))
    bend = wide.agg(F.max(F.abs(F.col("0") - 2 * F.col("1") + F.col("2")))).first()[0]
    assert bend < 1e-9  # one line per run
    sd0, sd_slope = wide.agg(F.stddev("0"), F.stddev(F.col("1") - F.col("0"))).first()
    assert sd0 == pytest.approx(0.1, abs=0.01) and sd_slope == pytest.approx(0.2, abs=0.02)


def test_dropout_draws(spark):
    net = nets.new_net(1, [10, 10, 2], ["sigmoid", "sigmoid", "linear"], seed=1)
    grid = generators.linspace(spark, 0, 1, 3)
    off = predictive.dropout_draws(grid, "grid_id", ["x"], net, 0.0, 5, 1)
    want = nets.forward(net, np.array([[0.0], [0.5], [1.0]]))[-1]
    for r in off.collect():
        assert (r["mu"], r["log_sigma"]) == pytest.approx(tuple(want[r["grid_id"]]))
    a = predictive.dropout_draws(grid, "grid_id", ["x"], net, 0.2, 50, 1)
    b = predictive.dropout_draws(grid.repartition(3), "grid_id", ["x"], net, 0.2, 50, 1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    mask = predictive.unit_mask(np.arange(20000), 10, 0, 0.2, 1)
    assert mask.mean() == pytest.approx(1.0, abs=0.01) and set(np.unique(mask)) == {0.0, 1.25}
    assert np.abs(np.corrcoef(mask.T) - np.eye(10)).max() < 0.03


# --- nets -----------------------------------------------------------------------------

@pytest.mark.parametrize("loss", ["mse", "hetero"])
def test_net_gradient_equals_finite_differences(loss):
    rng = np.random.default_rng(0)
    net = nets.new_net(2, [4, 3, 2], ["tanh", "sigmoid", "linear"], seed=3)
    x, y = rng.normal(size=(20, 2)), rng.normal(size=20)
    value = lambda flat: nets.LOSSES[loss](nets.forward(nets.unpack(net, flat), x)[-1], y)[0]
    trace = nets.forward(net, x)
    got, flat = nets.backward(net, trace, nets.LOSSES[loss](trace[-1], y)[1]), nets.pack(net)
    for i in range(len(flat)):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert got[i] == pytest.approx((value(flat + step) - value(flat - step)) / 2e-6, rel=1e-4, abs=1e-6)


def test_net_training_equals_one_machine(sine):
    df, x, y = sine
    net = nets.new_net(1, [4, 1], ["tanh", "linear"], seed=2)
    trained, history = nets.fit_net(df.repartition(3), ["x"], "y", net, "mse", {"kind": "constant", "rate": 0.02}, 4, l2=0.01)
    flat, decay = nets.pack(net), np.concatenate([np.r_[np.ones(l.weights.size), np.zeros(l.bias.size)] for l in net])
    losses = []
    for _ in range(4):
        now = nets.unpack(net, flat)
        trace = nets.forward(now, x[:, None])
        value, slope = nets.mse_loss(trace[-1], y)
        losses.append(value / len(x) + 0.01 * (decay * flat) @ flat)
        flat = flat - 0.02 * (nets.backward(now, trace, slope) / len(x) + 0.02 * decay * flat)
    assert nets.pack(trained) == pytest.approx(flat)
    assert [r["loss"] for r in history.orderBy("step").collect()] == pytest.approx(losses)


def test_frozen_sigma_head(sine):
    df, _, _ = sine
    mean_net, sigma_net = nets.new_net(1, [3, 1], ["tanh", "linear"], 1), nets.new_net(1, [3, 1], ["sigmoid", "linear"], 2)
    rate = {"kind": "constant", "rate": 0.01}
    (mu, sigma), _ = nets.fit_two_heads(df, ["x"], "y", mean_net, sigma_net, rate, rate, 2, sigma_start=5)
    assert (nets.pack(sigma) == nets.pack(sigma_net)).all() and (nets.pack(mu) != nets.pack(mean_net)).any()


# --- flows ----------------------------------------------------------------------------

CHAIN = [flows.Block(0.1, 0.9, 0.2, 1.1), flows.Block(-0.2, 1.1, -0.1, 0.95), flows.Block(0.3, 1.2, 0.1, 0.9)]


def test_sinh_arcsinh_fixture(spark):
    got = spark.range(1).select(flows.sinh_arcsinh(F.lit(1.0), 1.0, 1.0), flows.sinh_arcsinh(F.lit(0.7))).first()
    assert got[0] == pytest.approx(3.2050661, abs=1e-6) and got[1] == pytest.approx(0.7)


def test_density_integrates_to_one_and_matches_slope(spark):
    curve = flows.flow_curve(spark, CHAIN, -60, 60, 24001)
    assert curve.agg(F.sum("prob") * 120 / 24000).first()[0] == pytest.approx(1, abs=1e-3)
    df = spark.createDataFrame([(x, x + 1e-6) for x in (-2.0, 0.3, 1.7)], "a double, b double")
    z = flows.flow_inverse(flows.flow_inverse(df, "a", CHAIN, "za", "det"), "b", CHAIN, "zb")
    for r in z.collect():
        assert r["det"] == pytest.approx(math.log((r["zb"] - r["za"]) / 1e-6), abs=1e-4)


def test_flow_fit_lowers_nll_and_matches_gradient(spark):
    df = spark.range(3000).select((F.sin("id") * F.cos(F.col("id") * 0.37) * 2).alias("x"))
    chain, history = flows.fit_flow(df, "x", 2, {"kind": "constant", "rate": 0.05}, 6)
    losses = [r["loss"] for r in history.orderBy("step").collect()]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    assert losses[0] == pytest.approx(flows.flow_nll(df, "x", [flows.Block()] * 2).first()["nll"])
    points = spark.range(50).select((F.col("id") * 4 / 49 - 2).alias("x")).cache()
    params = np.array([[0.1, 0.9, 0.2, 1.1], [-0.2, 1.1, -0.1, 0.95]])
    got = 50 * flows.flow_slopes(points, "x", params)[1:]
    for i in range(params.size):
        step = np.zeros(params.size)
        step[i] = 1e-6
        up = 50 * flows.flow_slopes(points, "x", params + step.reshape(params.shape))[0]
        down = 50 * flows.flow_slopes(points, "x", params - step.reshape(params.shape))[0]
        assert got[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def test_flow_sample_follows_the_chain(spark):
    mean = flows.flow_inverse(flows.flow_sample(spark, CHAIN, 20000, 1), "x", CHAIN).agg(F.avg("z"), F.stddev("z")).first()
    assert mean[0] == pytest.approx(0, abs=0.03) and mean[1] == pytest.approx(1, abs=0.03)


def test_coupling_log_det_equals_finite_differences(spark):
    layers = [
        coupling.Coupling(
            (i % 2, 1 - i % 2), nets.new_net(2, [5, 2], ["relu", "tanh"], i), nets.new_net(2, [5, 2], ["relu", "linear"], 9 + i)
        )
        for i in range(4)
    ]
    h = 1e-6
    points = [(0, 0.3, -0.7), (1, 0.3 + h, -0.7), (2, 0.3, -0.7 + h)]
    df = spark.createDataFrame(points, "id int, x1 double, x2 double")
    a, b, c = coupling.coupling_inverse(df, "x1", "x2", layers).orderBy("id").collect()
    jac = np.array([[b["z1"] - a["z1"], b["z2"] - a["z2"]], [c["z1"] - a["z1"], c["z2"] - a["z2"]]]) / h
    assert a["log_det"] == pytest.approx(math.log(abs(np.linalg.det(jac))), abs=1e-4)
    trace = coupling.layer_trace(df, "id", "x1", "x2", layers)
    assert trace.count() == 15 and {r["start_quadrant"] for r in trace.collect()} == {"other"}


def test_grouped_fits_with_ranges_apart(spark):
    rng = np.random.default_rng(5)
    data = []
    for g, start in (("a", 0.0), ("b", 1000.0)):
        u = rng.uniform(0, 1, 400)
        data += [(g, float(start + v), float(1 + 2 * v + 3 * v**2 - v**3)) for v in u]
    df = spark.createDataFrame(data, "g string, x double, y double")
    for degree, bound in ((3, 1e-5), (9, 1e-3)):
        fits = m.fit_many(df, "x", "y", {"m": ("linear", degree, 0.0)}, "g")
        narrow = m.predict(df.where("g = 'a'"), fits, "x", by="g")
        assert narrow.agg(F.max(F.abs(F.col("yhat") - F.col("y")))).first()[0] < 1e-6
        if degree == 3:
            far = m.predict(df.where("g = 'b'"), fits, "x", by="g")
            assert far.agg(F.max(F.abs(F.col("yhat") - F.col("y")))).first()[0] < bound


@pytest.mark.parametrize("degree", [3, 5, 9])
def test_predictions_far_from_zero(spark, degree):
    """A narrow range of x around 1000: as good as the same fit on centred x."""
    rng = np.random.default_rng(3)
    x = rng.uniform(1000, 1001, 400)
    y = np.sin(6 * x) + 1.5 * rng.normal(size=400)
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    u = 2 * (x - x.min()) / np.ptp(x) - 1
    basis = np.polynomial.chebyshev.chebvander(u, degree)
    want = basis @ np.linalg.lstsq(basis, y, rcond=None)[0]
    for fitted, by in ((m.fit_ols(df, "x", "y", degree), None), (m.fit_many(df, "x", "y", {"m": ("linear", degree, 0.0)}, "g"), "g")):
        got = {r["x"]: r["yhat"] for r in m.predict(df, fitted, "x", by=by).collect()}
        assert [got[a] for a in x] == pytest.approx(want.tolist(), abs=1e-8)


def test_dropped_directions_are_reported(spark):
    rows = [("one", 7.0, 1.0), ("one", 7.0, 3.0), ("two", 1.0, 1.0), ("two", 2.0, 5.0), ("four", 0.0, 0.0), ("four", 1.0, 1.0), ("four", 2.0, 8.0), ("four", 3.0, 27.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    fits = m.fit_many(df, "x", "y", {"m": ("linear", 3, 0.0)}, "g")
    assert {(r["group"], r["dropped"]) for r in fits.collect()} == {("one", 3), ("two", 2), ("four", 0), (None, 3)}
    got = {(r["g"], r["x"]): r["yhat"] for r in m.predict(df, fits, "x", by="g").collect()}
    want = {("one", 7.0): 2.0, ("two", 1.0): 1.0, ("two", 2.0): 5.0, (None, 1.0): 1.0} | {("four", v): v**3 for v in (0.0, 1.0, 2.0, 3.0)}
    assert got == pytest.approx(want, abs=1e-8)
    assert m.powers(fits).columns == ["group", "model", "term", "value"]
    by_powers = {(r["g"], r["x"]): r["yhat"] for r in m.predict(df, m.powers(fits), "x", by="g").collect()}
    assert by_powers == pytest.approx(want, abs=1e-6)


def test_flow_slopes_by_differences(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=300)], "x double")
    params = np.array([[0.1, 0.8, 0.2, 1.1], [-0.2, 1.3, -0.1, 0.9], [0.0, 1.0, 0.0, 1.0]])
    got = flows.flow_slopes(df, "x", params)
    assert -got[0] == pytest.approx(flows.flow_nll(df, "x", [flows.Block(*p) for p in params]).first()[0], abs=1e-9)
    for k in (0, 1, 2, 3, 5, 7, 11):
        up, down = params.copy().ravel(), params.copy().ravel()
        up[k], down[k] = up[k] + 1e-5, down[k] - 1e-5
        slope = (flows.flow_slopes(df, "x", up.reshape(3, 4))[0] - flows.flow_slopes(df, "x", down.reshape(3, 4))[0]) / 2e-5
        assert got[1 + k] == pytest.approx(slope, abs=1e-5)


def test_flow_fit_converges(spark):
    rng = np.random.default_rng(4)
    truth = [flows.Block(0.3, 1.4, 0.5, 1.2)]
    base = spark.createDataFrame([(float(v),) for v in rng.normal(size=4_000)] + [(None,)], "z double")
    df = flows.flow_forward(base, "z", truth, "x")
    chain, history = flows.fit_flow_converged(df, "x", 1, 1e-4, 200)
    rows = history.orderBy("step").collect()
    assert rows[-1]["stopped"] == "gradient" and rows[-1]["gradient"] <= 1e-4 and rows[-1]["passes"] <= 80
    assert all(b["loss"] <= a["loss"] + 1e-12 for a, b in zip(rows, rows[1:]))
    nll = flows.flow_nll(df.dropna(), "x", chain).first()[0]
    assert rows[-1]["loss"] == pytest.approx(nll, abs=1e-9) and nll <= flows.flow_nll(df.dropna(), "x", truth).first()[0]
    few = flows.fit_flow_converged(df, "x", 1, 1e-9, 5)[1].where("stopped IS NOT NULL").first()
    assert (few["stopped"], few["passes"]) == ("passes", 5)
    none = flows.fit_flow_converged(df.where("x IS NULL"), "x", 1)[1].collect()
    assert [(r["loss"], r["stopped"]) for r in none] == [(None, "no rows")]


def test_training_stops_and_keeps_the_best(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=600)
    df = spark.createDataFrame([(i, float(a), float(np.tanh(2 * a) + 0.1 * b)) for i, (a, b) in enumerate(zip(x, rng.normal(size=600)))], "id long, x double, y double")
    train, held = df.where("id % 5 > 0"), df.where("id % 5 = 0")
    net = nets.new_net(1, [4, 1], ["tanh", "linear"], seed=2)
    # a rate that is too high in the end: the loss rises again, and training ends
    rising = {"kind": "constant", "rate": 1.2}
    trained, history = nets.fit_net(train, ["x"], "y", net, "mse", rising, 200, validation=held, stopping=nets.Stopping(5, 1e-4))
    rows = history.orderBy("step").collect()
    assert rows[-1]["stopped"] == "patience" and len(rows) < 200 and {r["stopped"] for r in rows[:-1]} == {None}
    out = nets.forward(trained, np.array([[r["x"]] for r in held.collect()]))[-1][:, 0]
    best = min(r["val_loss"] for r in rows)
    assert np.mean((out - np.array([r["y"] for r in held.collect()])) ** 2) == pytest.approx(best, abs=1e-3)
    ended = nets.fit_net(train, ["x"], "y", net, "mse", rising, 3, stopping=nets.Stopping(5))[1].orderBy("step").collect()
    assert [r["stopped"] for r in ended] == [None, None, "steps"]
    assert nets.fit_net(train.limit(0), ["x"], "y", net, steps=4)[1].first()["stopped"] == "no rows"


def test_batches_do_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("id", "id / 250.0 - 1 AS x", "sin(id / 80.0) AS y")
    net = nets.new_net(1, [3, 1], ["tanh", "linear"], seed=2)
    runs = []
    for parts in (2, 5):
        batches = nets.Batches("id", 0.3, 9)
        trained, history = nets.fit_net(df.repartition(parts), ["x"], "y", net, "mse", {"kind": "constant", "rate": 0.2}, 6, batches=batches)
        runs.append((nets.pack(trained), [r["loss"] for r in history.orderBy("step").collect()]))
    assert runs[0][0] == pytest.approx(runs[1][0], abs=1e-10) and runs[0][1] == pytest.approx(runs[1][1], abs=1e-10)
    full = nets.fit_net(df, ["x"], "y", net, "mse", {"kind": "constant", "rate": 0.2}, 6)[1].orderBy("step").collect()
    assert all(abs(a - b["loss"]) > 1e-6 for a, b in zip(runs[0][1], full))


def test_keys_stay_in_the_jvm(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 0.5, 0.25), (None, 0.1, 0.2)], "id long, x double, z double")
    out = nets.through_arrays(df, ["x", "z"], lambda a, b: np.column_stack([a + b]), ["s"])
    assert {(r["id"], round(r["s"], 6)) for r in out.collect()} == {(big, 0.75), (None, 0.3)}


@pytest.mark.parametrize("degree, alpha", [(6, 0.2), (9, 0.02)])
def test_lasso_over_collinear_powers_reaches_its_optimum(spark, degree, alpha):
    """The search by values ended 0.004 and 0.0005 away, with an error."""
    i = F.col("id")
    df = spark.range(3000).select((i % 50 + 1.0).alias("x"), ((i % 50 + 1.0) * (0.9 + i * 7919 % 1000 / 1000.0 * 1.2)).alias("y"))
    w = np.array([r["value"] for r in m.fit_lasso(df, "x", "y", degree, alpha).orderBy("term").collect()])
    rows = df.toPandas()
    powers = np.stack([rows.x.to_numpy() ** k for k in range(1, degree + 1)], axis=1)
    left = rows.y.to_numpy() - w[0] - powers @ w[1:]
    sd = powers.std(axis=0)
    slope = -(powers - powers.mean(axis=0)).T @ left / len(rows) / sd
    off = np.where(w[1:] == 0, np.maximum(np.abs(slope) - alpha / sd, 0), np.abs(slope + np.sign(w[1:]) * alpha / sd))
    assert off.max() < 1e-7 and abs(left.mean()) < 1e-7


def test_lasso_with_fewer_points_than_powers(spark):
    rows = [(float(x), float(x * x % 7)) for x in (1, 4, 9, 12, 17)]
    w = np.array([r["value"] for r in m.fit_lasso(spark.createDataFrame(rows, "x double, y double"), "x", "y", 7, 0.0056).orderBy("term").collect()])
    x, y = np.array(rows).T
    left = y - w[0] - sum(w[k] * x**k for k in range(1, 8))
    powers = np.stack([x**k for k in range(1, 8)], axis=1)
    sd = powers.std(axis=0)
    slope = -(powers - powers.mean(axis=0)).T @ left / 5 / sd
    assert np.where(w[1:] == 0, np.maximum(np.abs(slope) - 0.0056 / sd, 0), np.abs(slope + np.sign(w[1:]) * 0.0056 / sd)).max() < 1e-7


def test_batches_by_text_keys(spark):
    """Texts are drawn by their hash; they were cast to whole numbers, which raised."""
    df = spark.range(500).selectExpr("concat_ws('-', id, id % 7) AS k", "id / 250.0 - 1 AS x", "sin(id / 80.0) AS y")
    net = nets.new_net(1, [3, 1], ["tanh", "linear"], seed=2)
    runs = []
    for parts in (2, 5):
        trained, history = nets.fit_net(df.repartition(parts), ["x"], "y", net, steps=4, batches=nets.Batches("k", 0.3, 9))
        runs.append([*nets.pack(trained), *(r["loss"] for r in history.orderBy("step").collect())])
    assert runs[0] == pytest.approx(runs[1], abs=1e-10)
