"""Regression, likelihoods, training histories and predictive bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvelake.functions import likelihood as lk
from curvelake.models import nets, predictive
from curvelake.models import regression as m
from curvelake.operators import aggregates, joins, sampling
from curvelake.sources.generators import linspace_over

from .draws_sql import normal_sql, uniform_sql
from .registry import R, query, r, table


def items(spark, d):
    """Price in thousands against quantity."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y")
    )


ITEMS_SQL = """i AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem)"""


# --- features and scaling -------------------------------------------------------------

@query(
    "polynomial_features",
    "M1",
    """SELECT l_orderkey, l_linenumber, pow(l_quantity, 1) AS f1, pow(l_quantity, 2) AS f2, pow(l_quantity, 3) AS f3 FROM lineitem""",
)
def _(spark, d):
    out = m.poly_features(items(spark, d), "x", 3)
    return out.select("l_orderkey", "l_linenumber", *[F.col("features")[k].alias(f"f{k + 1}") for k in range(3)])


@query(
    "standardize_by_training_stats",
    "M2",
    f"""WITH s AS (SELECT avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx FROM lineitem)
        SELECT i AS grid_id, {R('(1 + i * 49.0 / 999 - mx) / sx')} AS x FROM s, range(1000) t(i)""",
)
def _(spark, d):
    train = items(spark, d)
    grid = linspace_over(train, "x", 1000)
    return m.standardize(grid, ["x"], m.feature_stats(train, ["x"])).select("grid_id", r("x").alias("x"))


# --- closed-form fits -----------------------------------------------------------------

LINE_TERMS = "SELECT '{name}' AS model, 0 AS term, {a} AS value FROM {src} UNION ALL SELECT '{name}', 1, {b} FROM {src}"


def _terms(name, a, b, src):
    return LINE_TERMS.format(name=name, a=R(a), b=R(b), src=src)


@query("fit_line", "M3", f"WITH {ITEMS_SQL} " + _terms("linear", "regr_intercept(y, x)", "regr_slope(y, x)", "i"))
def _(spark, d):
    return m.powers(m.fit_ols(items(spark, d), "x", "y", 1)).withColumn("value", r("value"))


@query(
    "fit_parabola",
    "M3",
    f"""WITH {ITEMS_SQL}, s AS (SELECT avg(x) AS mx, avg(x * x) AS mq, avg(y) AS my, covar_pop(x, x) AS cxx, covar_pop(x, x * x) AS cxq,
            covar_pop(x * x, x * x) AS cqq, covar_pop(x, y) AS cxy, covar_pop(x * x, y) AS cqy FROM i),
        w AS (SELECT *, (cxy * cqq - cqy * cxq) / (cxx * cqq - cxq * cxq) AS b1, (cqy * cxx - cxy * cxq) / (cxx * cqq - cxq * cxq) AS b2 FROM s)
        SELECT 0 AS term, {R('my - b1 * mx - b2 * mq')} AS value FROM w UNION ALL SELECT 1, {R('b1')} FROM w UNION ALL SELECT 2, {R('b2')} FROM w""",
)
def _(spark, d):
    return m.fit_ols(items(spark, d), "x", "y", 2).select("term", r("value").alias("value"))


RIDGE_SQL = """s AS (SELECT {g}avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, count(*) AS n FROM i{by}),
    w AS (SELECT *, sxy / (sxx + {alpha}) AS ridge,
          sign(sxy) * greatest(abs(sxy) / n - {lasso}, 0) / (sxx / n) AS lasso, sxy / sxx AS line FROM s)"""


@query(
    "fit_ridge_line",
    "M4",
    f"WITH {ITEMS_SQL}, {RIDGE_SQL.format(g='', by='', alpha=50000, lasso=0)} " + _terms("ridge", "my - ridge * mx", "ridge", "w"),
)
def _(spark, d):
    return m.powers(m.fit_ridge(items(spark, d), "x", "y", 1, 50000.0)).withColumn("value", r("value"))


@query(
    "fit_lasso_line",
    "M5",
    f"WITH {ITEMS_SQL}, {RIDGE_SQL.format(g='', by='', alpha=0, lasso=20)} " + _terms("lasso", "my - lasso * mx", "lasso", "w"),
)
def _(spark, d):
    return m.powers(m.fit_lasso(items(spark, d), "x", "y", 1, 20.0)).withColumn("value", r("value"))


SPECS = {"linear": ("linear", 1, 0.0), "ridge": ("ridge", 1, 5000.0), "lasso": ("lasso", 1, 5.0)}


@query(
    "fit_many_by_group",
    "M6 M3 M4 M5",
    f"WITH {ITEMS_SQL}, {RIDGE_SQL.format(g='l_returnflag AS g, ', by=' GROUP BY l_returnflag', alpha=5000, lasso=5)} "
    + " UNION ALL ".join(
        f"SELECT g AS \"group\", '{name}' AS model, {term} AS term, {R(value)} AS value FROM w"
        for name, col in (("linear", "line"), ("ridge", "ridge"), ("lasso", "lasso"))
        for term, value in ((0, f"my - {col} * mx"), (1, col))
    ),
)
def _(spark, d):
    return m.powers(m.fit_many(items(spark, d), "x", "y", SPECS, "l_returnflag")).withColumn("value", r("value"))


@query("fit_degree_9_with_penalties", "M6 M3 M4 M5 A21 U2")
def _(spark, d):
    specs = {"linear": ("linear", 9, 0.0), "ridge": ("ridge", 9, 0.5), "lasso": ("lasso", 9, 0.02)}
    return aggregates.coefficient_table(m.fit_many(items(spark, d), "x", "y", specs), list(specs))


@query(
    "coefficient_table",
    "A21",
    f"""WITH {ITEMS_SQL}, {RIDGE_SQL.format(g='', by='', alpha=5000, lasso=5)}
        SELECT 0 AS term, {R('my - line * mx')} AS linear, {R('my - ridge * mx')} AS ridge, {R('my - lasso * mx')} AS lasso FROM w
        UNION ALL SELECT 1, {R('line')}, {R('ridge')}, {R('lasso')} FROM w""",
)
def _(spark, d):
    out = aggregates.coefficient_table(m.fit_many(items(spark, d), "x", "y", SPECS), list(SPECS))
    return out.select("term", *[r(c).alias(c) for c in SPECS])


@query(
    "predict_on_rows",
    "M7",
    f"""WITH {ITEMS_SQL}, s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM i)
        SELECT l_orderkey, l_linenumber, {R('a + b * x')} AS yhat FROM i, s""",
)
def _(spark, d):
    data = items(spark, d)
    return m.predict(data, m.fit_ols(data, "x", "y", 1), "x").select("l_orderkey", "l_linenumber", r("yhat").alias("yhat"))


@query(
    "predict_by_group",
    "M7 M6",
    f"""WITH {ITEMS_SQL}, s AS (SELECT l_returnflag, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM i GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, {R('a + b * x')} AS yhat FROM i JOIN s USING (l_returnflag)""",
)
def _(spark, d):
    data = items(spark, d)
    coefs = m.fit_many(data, "x", "y", {"linear": ("linear", 1, 0.0)}, "l_returnflag")
    return m.predict(data, coefs, "x", by="l_returnflag").select("l_orderkey", "l_linenumber", r("yhat").alias("yhat"))


@query(
    "mean_squared_error",
    "M8",
    f"""WITH {ITEMS_SQL}, s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM i)
        SELECT {R('avg(pow(y - a - b * x, 2))')} AS mse FROM i, s""",
)
def _(spark, d):
    data = items(spark, d)
    out = m.evaluate(m.predict(data, m.fit_ols(data, "x", "y", 1), "x"), "y", "yhat")
    return out.select(r("mse").alias("mse"))


def narrow(spark, d):
    """Prices moved to a range of about 1 for each return flag, a thousand and more from 0."""
    away = F.lit(1000.0) * (1 + F.ascii("l_returnflag") % 3)
    at = (away + F.col("l_extendedprice").cast("double") / F.lit(100000.0)).alias("x")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", at, F.col("l_quantity").cast("double").alias("y"))


def _narrow_sql(degree: int) -> str:
    """Least squares by orthogonal polynomials of the centred x, one three-term step per degree, per group."""
    ctes = [
        f"""q0 AS (SELECT l_orderkey, l_linenumber, g, y, x - avg(x) OVER (PARTITION BY g) AS x, 1.0::DOUBLE AS p, 0.0::DOUBLE AS b4, 1.0::DOUBLE AS n4,
            0.0::DOUBLE AS yhat FROM (SELECT l_orderkey, l_linenumber, l_returnflag AS g, l_quantity::DOUBLE AS y,
            1000.0::DOUBLE * (1 + ascii(l_returnflag) % 3) + l_extendedprice::DOUBLE / 100000.0::DOUBLE AS x FROM lineitem))"""
    ]
    for k in range(degree + 1):
        ctes.append(
            f"""s{k} AS (SELECT g, sum(p * p) AS nn, sum(x * p * p) / sum(p * p) AS a, sum(y * p) / sum(p * p) AS c FROM q{k} GROUP BY g),
            q{k + 1} AS (SELECT l_orderkey, l_linenumber, g, y, x, (x - a) * p - {"0" if k == 0 else "nn / n4"} * b4 AS p, p AS b4, nn AS n4, yhat + c * p AS yhat
                FROM q{k} JOIN s{k} USING (g))"""
        )
    return f"WITH {', '.join(ctes)} SELECT l_orderkey, l_linenumber, {R('yhat', 5)} AS yhat FROM q{degree + 1}"


@query("predict_narrow_groups_5", "M7 M6", _narrow_sql(5))
def _(spark, d):
    data = narrow(spark, d)
    coefs = m.fit_many(data, "x", "y", {"linear": ("linear", 5, 0.0)}, "l_returnflag")
    return m.predict(data, coefs, "x", by="l_returnflag").select("l_orderkey", "l_linenumber", r("yhat", 5).alias("yhat"))


@query("predict_narrow_groups_9", "M7 M6", _narrow_sql(9))
def _(spark, d):
    data = narrow(spark, d)
    coefs = m.fit_many(data, "x", "y", {"linear": ("linear", 9, 0.0)}, "l_returnflag")
    return m.predict(data, coefs, "x", by="l_returnflag").select("l_orderkey", "l_linenumber", r("yhat", 5).alias("yhat"))


@query(
    "fit_dropped_rank",
    "M6 M3",
    f"""WITH {ITEMS_SQL} SELECT l_orderkey AS "group", greatest(0, 4 - count(DISTINCT x))::INTEGER AS dropped FROM i GROUP BY l_orderkey""",
)
def _(spark, d):
    """An order has a few lines: a cubic is not settled by fewer than four different x."""
    coefs = m.fit_many(items(spark, d), "x", "y", {"cubic": ("linear", 3, 0.0)}, "l_orderkey")
    return coefs.groupBy("group").agg(F.max("dropped").alias("dropped"))


# --- gradient descent -----------------------------------------------------------------

EXPONENTIAL = {"kind": "exponential", "rate": 0.2, "decay": 0.96, "steps": 10}
GD_SQL = """z AS (SELECT (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, y FROM i),
    s AS (SELECT avg(x) AS mx, avg(x * x) AS mxx, avg(y) AS my, avg(x * y) AS mxy, avg(y * y) AS myy FROM z),
    gd AS (SELECT 0 AS step, 0.5::DOUBLE AS a, -0.5::DOUBLE AS b FROM s
        UNION ALL
        SELECT step + 1, a - 0.2 * pow(0.96, step / 10.0) * 2 * (a + b * mx - my),
               b - 0.2 * pow(0.96, step / 10.0) * 2 * (a * mx + b * mxx - mxy) FROM gd, s WHERE step < 40)"""


def _gradient(spark, d):
    data = m.standardize(items(spark, d).select("x", "y"), ["x"])
    return m.fit_gradient(data, ["x"], "y", EXPONENTIAL, 40, init=[0.5, -0.5])


@query(
    "gradient_descent_coefficients",
    "M9",
    f"WITH RECURSIVE {ITEMS_SQL}, {GD_SQL} SELECT 0 AS term, {R('a')} AS value FROM gd WHERE step = 40 UNION ALL SELECT 1, {R('b')} FROM gd WHERE step = 40",
)
def _(spark, d):
    return _gradient(spark, d)[0].select("term", r("value").alias("value"))


@query(
    "gradient_descent_loss",
    "M9 M24",
    f"""WITH RECURSIVE {ITEMS_SQL}, {GD_SQL}
        SELECT step, {R('a * a + 2 * a * b * mx + b * b * mxx - 2 * a * my - 2 * b * mxy + myy')} AS loss FROM gd, s WHERE step < 40""",
)
def _(spark, d):
    return _gradient(spark, d)[1].select("step", r("loss").alias("loss"))


@query(
    "learning_rates",
    "M10",
    f"""SELECT o_orderkey AS step, {R('0.0007 * pow(0.96, o_orderkey / 2000)', 12)} AS smooth,
        {R('0.4 * pow(0.96, floor(o_orderkey / 1000))', 12)} AS floored,
        CASE WHEN o_orderkey > 10000 THEN 0.000005::DOUBLE WHEN o_orderkey > 1000 THEN 0.0001 WHEN o_orderkey > 100 THEN 0.001 ELSE 0.01 END AS step_table
        FROM orders""",
)
def _(spark, d):
    smooth = {"kind": "exponential", "rate": 0.0007, "decay": 0.96, "steps": 2000}
    floored = {"kind": "exponential", "rate": 0.4, "decay": 0.96, "steps": 1000, "floored": True}
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("step"),
        r(lk.learning_rate("o_orderkey", smooth), 12).alias("smooth"),
        r(lk.learning_rate("o_orderkey", floored), 12).alias("floored"),
        lk.learning_rate("o_orderkey", {"kind": "table"}).alias("step_table"),
    )


@query(
    "early_stop_per_run",
    "M11",
    """WITH h AS (SELECT event_type AS run, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS step, max(value) AS loss FROM events GROUP BY ALL),
       b AS (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM h),
       g AS (SELECT *, max(CASE WHEN best IS NULL OR loss < best THEN step END) OVER (PARTITION BY run ORDER BY step) AS gain FROM b),
       s AS (SELECT run, coalesce(min(CASE WHEN step - gain >= 30 THEN step END), max(step)) AS stop_step FROM g GROUP BY run)
       SELECT run, max(gain) AS best_step, min(loss) AS best_loss, max(stop_step) AS stop_step
       FROM g JOIN s USING (run) WHERE step <= stop_step GROUP BY run""",
)
def _(spark, d):
    minute = F.hour("ts") * 60 + F.minute("ts")  # at most 1440 steps per run
    history = table(spark, d, "events").groupBy(F.col("event_type").alias("run"), minute.alias("step")).agg(
        F.max("value").alias("loss")
    )
    return m.early_stop(history, patience=30, by=["run"])


# --- likelihood -----------------------------------------------------------------------

@query(
    "constant_sigma_nll",
    "M12",
    f"""WITH {ITEMS_SQL} SELECT {R('sum(0.5 * ln(2 * pi()) + ln(3.0::DOUBLE) + 0.5 * pow((y - x) / 3, 2))', 2)} AS nll FROM i""",
)
def _(spark, d):
    import math

    return items(spark, d).agg(r(F.sum(lk.normal_nll("y", "x", F.lit(math.log(3.0)))), 2).alias("nll"))


@query(
    "varying_sigma_nll",
    "M13",
    f"""WITH {ITEMS_SQL} SELECT {R('sum(0.5 * ln(2 * pi()) + (0.5 + x / 50) + 0.5 * pow((y - x) / exp(0.5 + x / 50), 2))', 2)} AS nll FROM i""",
)
def _(spark, d):
    return items(spark, d).agg(r(F.sum(lk.normal_nll("y", "x", 0.5 + F.col("x") / 50)), 2).alias("nll"))


@query(
    "linked_scale_nll",
    "M14 P23",
    f"""WITH {ITEMS_SQL}, l AS (SELECT l_orderkey, l_linenumber, x, y, 0.001 + ln(1 + exp(0.05 * x)) AS s FROM i)
        SELECT l_orderkey, l_linenumber, {R('0.5 * ln(2 * pi()) + ln(s) + 0.5 * pow((y - x) / s, 2)')} AS softplus,
        {R('0.5 * ln(2 * pi()) + x / 50 + 0.5 * pow((y - x) / exp(x / 50), 2)')} AS exponential FROM l""",
)
def _(spark, d):
    return items(spark, d).select(
        "l_orderkey",
        "l_linenumber",
        r(lk.linked_nll("y", "x", "x", "softplus")).alias("softplus"),
        r(lk.linked_nll("y", "x", F.col("x") / 50, "exp")).alias("exponential"),
    )


@query(
    "fit_gaussian_model",
    "M15",
    f"""WITH {ITEMS_SQL}, s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
            sqrt((regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / count(*)) AS sd, count(*) AS n FROM i)
        SELECT 0 AS term, {R('a', 5)} AS value FROM s UNION ALL SELECT 1, {R('b', 5)} FROM s UNION ALL SELECT -1, {R('sd', 5)} FROM s
        UNION ALL SELECT -2, {R('-n * (0.5 * ln(2 * pi()) + ln(sd) + 0.5)', 2)} FROM s""",
)
def _(spark, d):
    out = m.fit_gaussian(items(spark, d), ["x"], "y")
    return out.select("term", F.when(F.col("term") == -2, r("value", 2)).otherwise(r("value", 5)).alias("value"))


def _hetero_sql(updates: int) -> str:
    """Fisher scoring written out step by step for one feature."""
    ctes = [
        "z AS (SELECT (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, y FROM i)",
        """p0 AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b,
            0.5 * ln((regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / count(*)) AS c, 0.0::DOUBLE AS e FROM z)""",
    ]
    for k in range(updates):
        ctes.append(
            f"""r{k} AS (SELECT x, y, exp(-2 * (c + e * x)) AS w, pow(y - a - b * x, 2) * exp(-2 * (c + e * x)) - 1 AS q, c, e FROM z, p{k}),
            s{k} AS (SELECT sum(w) AS w0, sum(w*x) AS w1, sum(w*x*x) AS w2, sum(w*y) AS v0, sum(w*x*y) AS v1, sum(q) AS g0, sum(q*x) AS g1,
                2.0 * count(*) AS h0, 2 * sum(x) AS h1, 2 * sum(x*x) AS h2, any_value(c) AS c, any_value(e) AS e FROM r{k}),
            p{k + 1} AS (SELECT (v0*w2 - v1*w1) / (w0*w2 - w1*w1) AS a, (w0*v1 - w1*v0) / (w0*w2 - w1*w1) AS b,
                c + (g0*h2 - g1*h1) / (h0*h2 - h1*h1) AS c, e + (h0*g1 - h1*g0) / (h0*h2 - h1*h1) AS e FROM s{k})"""
        )
    rows = [("hetero_mean", 0, "a"), ("hetero_mean", 1, "b"), ("hetero_log_sigma", 0, "c"), ("hetero_log_sigma", 1, "e")]
    return f"WITH {ITEMS_SQL}, {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT '{model}' AS model, {term} AS term, {R(col)} AS value FROM p{updates}" for model, term, col in rows
    )


@query("fit_varying_sigma", "M16", _hetero_sql(4))
def _(spark, d):
    data = m.standardize(items(spark, d).select("x", "y"), ["x"])
    return m.fit_hetero(data, ["x"], ["x"], "y", 5)[0].withColumn("value", r("value"))


# --- bands and draws ------------------------------------------------------------------

@query(
    "sigma_band",
    "M17",
    f"""WITH {ITEMS_SQL} SELECT l_returnflag, {R('avg(y) - 2 * stddev_pop(y)')} AS lower, {R('avg(y) + 2 * stddev_pop(y)')} AS upper
        FROM i GROUP BY ALL""",
)
def _(spark, d):
    stats = items(spark, d).groupBy("l_returnflag").agg(F.avg("y").alias("mu"), F.stddev_pop("y").alias("sd"))
    return m.sigma_band(stats, "mu", "sd").select("l_returnflag", r("lower").alias("lower"), r("upper").alias("upper"))


DRAWS_SQL = """d AS (SELECT c_custkey, i, c_acctbal / 1000 + i / 10.0::DOUBLE AS mu, (c_custkey % 7 + i) / 20.0::DOUBLE AS ls
                   FROM customer, range(20) t(i))"""


def _run_outputs(spark, d):
    runs = joins.repeat_runs(table(spark, d, "customer").select("c_custkey", "c_acctbal"), 20)
    return runs.select(
        "c_custkey",
        "run",
        (F.col("c_acctbal") / 1000 + F.col("run") / 10).alias("mu"),
        ((F.col("c_custkey") % 7 + F.col("run")) / 20).alias("ls"),
    )


@query(
    "run_averaged_sigma_band",
    "M17 J5",
    f"""WITH {DRAWS_SQL} SELECT c_custkey, {R('avg(mu)')} AS mu, {R('avg(mu) - 2 * (SELECT avg(exp(ls)) FROM d)')} AS lower,
        {R('avg(mu) + 2 * (SELECT avg(exp(ls)) FROM d)')} AS upper FROM d GROUP BY c_custkey""",
)
def _(spark, d):
    out = m.averaged_sigma_band(_run_outputs(spark, d), ["c_custkey"], "mu", "ls")
    return out.select("c_custkey", *[r(c).alias(c) for c in ("mu", "lower", "upper")])


#: Grid points and runs of the predictive draws, as in the reference.
POINTS, RUNS = 1_000, 200


GRID_SQL = f"""{ITEMS_SQL}, e AS (SELECT min(x) AS lo, max(x) AS hi FROM i),
    g AS (SELECT k AS grid_id, lo + k * (hi - lo) / {POINTS - 1} AS x FROM e, range({POINTS}) t(k))"""


def _summary_sql(source: str) -> str:
    quantiles = ", ".join(f"{R(f'quantile_cont(y, {p})')} AS {name}" for p, name in ((0.025, "lower"), (0.975, "upper")))
    return f"SELECT grid_id, {R('avg(y)')} AS mean, {quantiles} FROM {source} GROUP BY grid_id"


def _rounded(df, *names):
    return df.withColumns({n: r(n) for n in names})


@query(
    "predictive_draws",
    "M18 J5",
    f"""WITH {GRID_SQL} SELECT grid_id, {R('x')} AS x, {R('1.5 * x')} AS mu, {R('1 + x / 10')} AS sigma, run::INTEGER AS run,
        {R(f"1.5 * x + (1 + x / 10) * {normal_sql('grid_id', 'run', seed=1)}")} AS y_draw FROM g, range({RUNS}) t(run)""",
)
def _(spark, d):
    grid = linspace_over(items(spark, d), "x", POINTS)
    model = grid.withColumns({"mu": 1.5 * F.col("x"), "sigma": 1 + F.col("x") / 10})
    return _rounded(predictive.predictive_draws(model, "grid_id", "mu", "sigma", RUNS, 1), "x", "mu", "sigma", "y_draw")


@query(
    "draw_summary",
    "M19 A19",
    f"""WITH {DRAWS_SQL} SELECT c_custkey, {R('avg(mu)')} AS mean, {R('quantile_cont(mu, 0.025)')} AS lower,
        {R('quantile_cont(mu, 0.975)')} AS upper FROM d GROUP BY c_custkey""",
)
def _(spark, d):
    out = predictive.draw_summary(_run_outputs(spark, d), ["c_custkey"], "mu")
    return out.select("c_custkey", *[r(c).alias(c) for c in ("mean", "lower", "upper")])


@query(
    "weight_draws",
    "M20 M19",
    f"""WITH {GRID_SQL}, w AS (SELECT run, 0.5 + 0.3 * {normal_sql('run', 0, seed=3)} AS a, 1.4 + 0.05 * {normal_sql('run', 1, seed=3)} AS b
            FROM range({RUNS}) t(run)), d AS (SELECT grid_id, a + b * x AS y FROM g, w) {_summary_sql('d')}""",
)
def _(spark, d):
    grid = linspace_over(items(spark, d), "x", POINTS)
    drawn = predictive.weight_draws(grid, ["x"], [0.5, 1.4], [0.3, 0.05], RUNS, 3)
    return _rounded(predictive.draw_summary(drawn, ["grid_id"]), "mean", "lower", "upper")


DROPOUT_NET = nets.new_net(1, [10, 20, 6, 2], ["sigmoid", "sigmoid", "sigmoid", "linear"], seed=4)


def _dropout_sql() -> str:
    """The net layer by layer: lists of kept units, weights as lists of lists."""
    ctes, before = [f"h0 AS (SELECT grid_id, run, [x / 50] AS h FROM g, range({RUNS}) t(run))"], "h0"
    for n, layer in enumerate(DROPOUT_NET):
        rows = "[" + ", ".join("[" + ", ".join(f"{v!r}::DOUBLE" for v in map(float, column)) + "]" for column in layer.weights.T) + "]"
        z = f"list_dot_product({rows}[u + 1], h)"
        if n < len(DROPOUT_NET) - 1:
            keep = f"CASE WHEN {uniform_sql('grid_id', 'run', n, 'u', seed=5)} >= 0.2 THEN 1 / (1 - 0.2::DOUBLE) ELSE 0 END"
            z = f"1 / (1 + exp(-{z})) * {keep}"
        ctes.append(f"h{n + 1} AS (SELECT grid_id, run, list_transform(range({layer.weights.shape[1]}), lambda u: {z}) AS h FROM {before})")
        before = f"h{n + 1}"
    return f"WITH {GRID_SQL}, {', '.join(ctes)}, d AS (SELECT grid_id, h[1] AS y FROM {before}) {_summary_sql('d')}"


@query("dropout_draws", "M21 M19", _dropout_sql())
def _(spark, d):
    grid = linspace_over(items(spark, d), "x", POINTS).withColumn("x", F.col("x") / 50)
    drawn = predictive.dropout_draws(grid, "grid_id", ["x"], DROPOUT_NET, 0.2, RUNS, 5)
    return _rounded(predictive.draw_summary(drawn, ["grid_id"], "mu"), "mean", "lower", "upper")


# --- nets -----------------------------------------------------------------------------

#: Most epochs of the nets' training, as in the reference; a loss that has not fallen by a thousandth for so many steps ends it.
EPOCHS, ENOUGH = 2_000, nets.Stopping(10, 1e-3)


@query("net_training_history", "M22 M24 L6")
def _(spark, d):
    data = m.standardize(items(spark, d).select("l_orderkey", "x", "y"), ["x", "y"])
    parts = sampling.hash_split(data, "l_orderkey", 0.2, 1)
    net = nets.new_net(1, [5, 10, 5, 1], ["tanh", "tanh", "tanh", "linear"], seed=1)
    _, history = nets.fit_net(
        parts.where("part = 'train'"), ["x"], "y", net, "mse", {"kind": "constant", "rate": 0.1}, EPOCHS,
        validation=parts.where("part = 'validation'"), stopping=ENOUGH,
    )
    return history


@query("net_training_batches", "M22 M24")
def _(spark, d):
    """Half of the rows a step, picked by the hash of their key."""
    data = m.standardize(items(spark, d), ["x", "y"]).withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    net = nets.new_net(1, [5, 1], ["tanh", "linear"], seed=1)
    _, history = nets.fit_net(
        data, ["x"], "y", net, "mse", {"kind": "constant", "rate": 0.3}, EPOCHS, stopping=ENOUGH, batches=nets.Batches("key", 0.5, 3)
    )
    return history


@query("two_head_training_history", "M23 M24")
def _(spark, d):
    data = m.standardize(items(spark, d).select("x", "y"), ["x", "y"])
    mean_net = nets.new_net(1, [6, 1], ["tanh", "linear"], seed=1)
    sigma_net = nets.new_net(1, [6, 1], ["sigmoid", "linear"], seed=2)
    rate = {"kind": "constant", "rate": 0.1}
    _, history = nets.fit_two_heads(data, ["x"], "y", mean_net, sigma_net, rate, rate, EPOCHS, sigma_start=4, stopping=ENOUGH)
    return history


TINY = nets.new_net(1, [2, 1], ["tanh", "linear"], seed=6)


def _tiny_net_sql(steps: int, rate: float) -> str:
    """Back-propagation of a net with two hidden units, written out step by step."""
    (u, w), b = TINY[0].weights[0], TINY[0].bias
    (s, t), c = TINY[1].weights[:, 0], TINY[1].bias
    start = dict(u=u, w=w, bu=b[0], bw=b[1], s=s, t=t, c=c[0])
    num = lambda v: f"({float(v)!r}::DOUBLE)"
    ctes = [
        "z AS (SELECT (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM i)",
        "p0 AS (SELECT " + ", ".join(f"{num(v)} AS {k}" for k, v in start.items()) + ")",
    ]
    for k in range(steps):
        ctes.append(
            f"""h{k} AS (SELECT x, y, tanh(u * x + bu) AS hu, tanh(w * x + bw) AS hw, p{k}.* FROM z, p{k}),
            r{k} AS (SELECT *, s * hu + t * hw + c - y AS r FROM h{k}),
            p{k + 1} AS (SELECT avg(r * r) AS loss,
                any_value(s) - {rate} * 2 * avg(r * hu) AS s, any_value(t) - {rate} * 2 * avg(r * hw) AS t, any_value(c) - {rate} * 2 * avg(r) AS c,
                any_value(u) - {rate} * 2 * avg(r * s * (1 - hu * hu) * x) AS u, any_value(w) - {rate} * 2 * avg(r * t * (1 - hw * hw) * x) AS w,
                any_value(bu) - {rate} * 2 * avg(r * s * (1 - hu * hu)) AS bu, any_value(bw) - {rate} * 2 * avg(r * t * (1 - hw * hw)) AS bw
                FROM r{k})"""
        )
    return f"WITH {ITEMS_SQL}, {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT {k} AS step, {R('loss')} AS loss FROM p{k + 1}" for k in range(steps)
    )


@query("net_training_steps", "M22 M24", _tiny_net_sql(4, 0.3))
def _(spark, d):
    data = m.standardize(items(spark, d).select("x", "y"), ["x", "y"])
    _, history = nets.fit_net(data, ["x"], "y", TINY, "mse", {"kind": "constant", "rate": 0.3}, 4)
    return history.select("step", r("loss").alias("loss"))


LINE_HEADS = [nets.new_net(1, [1], ["linear"], seed=k) for k in (8, 9)]


def _two_head_sql(steps: int, rate: float, sigma_start: int) -> str:
    """Gradient steps for a line as mean and a line as log sigma that starts later."""
    num = lambda v: f"({float(v)!r}::DOUBLE)"
    a, e = (net[0].weights[0, 0] for net in LINE_HEADS)
    ctes = [
        "z AS (SELECT (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM i)",
        f"p0 AS (SELECT {num(a)} AS a, 0.0::DOUBLE AS b, {num(e)} AS e, 0.0::DOUBLE AS f)",
    ]
    for k in range(steps):
        late = rate if k >= sigma_start else 0.0
        ctes.append(
            f"""r{k} AS (SELECT x, a, b, e, f, e * x + f AS ls, a * x + b - y AS r, exp(-2 * (e * x + f)) AS w FROM z, p{k}),
            p{k + 1} AS (SELECT avg(ls + 0.5 * r * r * w + 0.5 * ln(2 * pi())) AS loss, any_value(a) - {rate} * avg(r * w * x) AS a,
                any_value(b) - {rate} * avg(r * w) AS b, any_value(e) - {late} * avg((1 - r * r * w) * x) AS e,
                any_value(f) - {late} * avg(1 - r * r * w) AS f FROM r{k})"""
        )
    return f"WITH {ITEMS_SQL}, {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT {k} AS step, {R('loss')} AS loss FROM p{k + 1}" for k in range(steps)
    )


@query("two_head_training_steps", "M23 M24", _two_head_sql(5, 0.1, 2))
def _(spark, d):
    data = m.standardize(items(spark, d).select("x", "y"), ["x", "y"])
    rate = {"kind": "constant", "rate": 0.1}
    _, history = nets.fit_two_heads(data, ["x"], "y", *LINE_HEADS, rate, rate, 5, sigma_start=2)
    return history.select("step", r("loss").alias("loss"))
