"""Invertible-map densities on event values and on embedding coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvelake.functions.likelihood import diagonal_normal_log_prob
from curvelake.models import coupling, flows
from curvelake.models.nets import new_net
from curvelake.models.regression import standardize
from curvelake.operators.joins import attach_scalars
from curvelake.sources import generators

from .draws_sql import normal_sql
from .registry import R, query, r, table

# A given chain; the values are near those of a fit to the scaled event values.
CHAIN = [
    flows.Block(0.1, 0.9, 0.2, 1.1),
    flows.Block(-0.2, 1.1, -0.1, 0.95),
    flows.Block(0.05, 0.8, 0.15, 1.05),
    flows.Block(0.0, 1.2, -0.2, 0.9),
    flows.Block(0.3, 1.0, 0.1, 1.0),
]
SCALED = "(value - 100) / 100"


def scaled(spark, d):
    return table(spark, d, "events").select("event_id", ((F.col("value") - 100) / 100).alias("x"))


def forward_sql(source: str, col: str, keep: str, out: str = "fwd") -> str:
    """CTEs that map column ``col`` of ``source`` through the chain; result column v."""
    steps, before = [f"{out}0 AS (SELECT {keep}, {col} AS v FROM {source})"], f"{out}0"
    for i, b in enumerate(reversed(CHAIN), 1):
        name = out if i == len(CHAIN) else f"{out}{i}"
        steps.append(
            f"{name} AS (SELECT * REPLACE (sinh((asinh(v) + {b.skew}) * {b.tail}::DOUBLE) * {b.scale}::DOUBLE + {b.shift} AS v) FROM {before})"
        )
        before = name
    return ", ".join(steps)


def inverse_sql(source: str, col: str, keep: str, out: str = "inv") -> str:
    """CTEs for the inverse with log determinant; result columns v and det."""
    steps, before = [f"{out}0 AS (SELECT {keep}, {col} AS v, 0.0::DOUBLE AS det FROM {source})"], f"{out}0"
    for i, b in enumerate(CHAIN, 1):
        name = out if i == len(CHAIN) else f"{out}{i}"
        u, t = f"((v - {b.shift}) / {b.scale}::DOUBLE)", f"(asinh((v - {b.shift}) / {b.scale}::DOUBLE) / {b.tail}::DOUBLE - {b.skew})"
        steps.append(
            f"{name} AS (SELECT * REPLACE (sinh({t}) AS v, det - ln({b.scale}::DOUBLE) - ln({b.tail}::DOUBLE) + ln(cosh({t})) - 0.5 * ln(1 + {u} * {u}) AS det) FROM {before})"
        )
        before = name
    return ", ".join(steps)


EVENTS_SQL = f"e AS (SELECT event_id, {SCALED} AS x FROM events)"
LOG_PROB = "(det - 0.5 * ln(2 * pi()) - 0.5 * v * v)"


@query(
    "sinh_arcsinh",
    "N1",
    f"""WITH {EVENTS_SQL} SELECT event_id, {R('sinh(asinh(x) + 1)')} AS right_skew, {R('sinh(asinh(x) - 1)')} AS left_skew,
        {R('sinh(asinh(x) * 0.5)')} AS light_tail FROM e""",
)
def _(spark, d):
    return scaled(spark, d).select(
        "event_id",
        r(flows.sinh_arcsinh("x", 1.0, 1.0)).alias("right_skew"),
        r(flows.sinh_arcsinh("x", -1.0, 1.0)).alias("left_skew"),
        r(flows.sinh_arcsinh("x", 0.0, 0.5)).alias("light_tail"),
    )


@query("flow_forward", "N2", f"WITH {EVENTS_SQL}, {forward_sql('e', 'x', 'event_id')} SELECT event_id, {R('v')} AS x FROM fwd")
def _(spark, d):
    return flows.flow_forward(scaled(spark, d), "x", CHAIN, "x").select("event_id", r("x").alias("x"))


@query("flow_inverse", "N3", f"WITH {EVENTS_SQL}, {inverse_sql('e', 'x', 'event_id')} SELECT event_id, {R('v')} AS z FROM inv")
def _(spark, d):
    return flows.flow_inverse(scaled(spark, d), "x", CHAIN).select("event_id", r("z").alias("z"))


@query(
    "flow_log_prob",
    "N4",
    f"""WITH {EVENTS_SQL}, {inverse_sql('e', 'x', 'event_id')}
        SELECT event_id, {R(LOG_PROB)} AS log_prob, {R(f'exp({LOG_PROB})')} AS prob FROM inv""",
)
def _(spark, d):
    out = flows.flow_log_prob(scaled(spark, d), "x", CHAIN)
    return out.select("event_id", r("log_prob").alias("log_prob"), r(F.exp("log_prob")).alias("prob"))


@query("flow_nll", "N5", f"WITH {EVENTS_SQL}, {inverse_sql('e', 'x', 'event_id')} SELECT {R(f'-avg({LOG_PROB})')} AS nll FROM inv")
def _(spark, d):
    return flows.flow_nll(scaled(spark, d), "x", CHAIN).select(r("nll").alias("nll"))


@query("fit_flow_history", "N6 S10")
def _(spark, d):
    """Five blocks. The density has an edge, which more blocks sharpen for ever, so the fit ends when ten points gain less than a thousandth."""
    _, history = flows.fit_flow_converged(generators_scaled(spark, d), "x", 5, passes=120, patience=10, min_delta=1e-3)
    return history


def generators_scaled(spark, d):
    return standardize(table(spark, d, "events").select(F.col("value").alias("x")), ["x"])


def _one_block_sql(steps: int, rate: float) -> str:
    """Gradient steps for one block, written out by the chain rule."""
    ctes = [
        "z AS (SELECT (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS x FROM events)",
        "p0 AS (SELECT 0.0::DOUBLE AS shift, 1.0::DOUBLE AS scale, 0.0::DOUBLE AS skew, 1.0::DOUBLE AS tail)",
    ]
    for k in range(steps):
        ctes.append(
            f"""u{k} AS (SELECT (x - shift) / scale AS u, p{k}.* FROM z, p{k}),
            t{k} AS (SELECT *, asinh(u) / tail - skew AS t FROM u{k}),
            d{k} AS (SELECT *, -sinh(t) * cosh(t) + tanh(t) AS dt FROM t{k}),
            g{k} AS (SELECT *, dt / (tail * sqrt(1 + u * u)) - u / (1 + u * u) AS du FROM d{k}),
            p{k + 1} AS (SELECT
                avg(ln(scale) + ln(tail) - ln(cosh(t)) + 0.5 * ln(1 + u * u) + 0.5 * ln(2 * pi()) + 0.5 * sinh(t) * sinh(t)) AS loss,
                any_value(shift) + {rate} * avg(-du / scale) AS shift,
                any_value(scale) + {rate} * avg(-du * u / scale - 1 / scale) AS scale,
                any_value(skew) + {rate} * avg(-dt) AS skew,
                any_value(tail) + {rate} * avg(-dt * asinh(u) / (tail * tail) - 1 / tail) AS tail FROM g{k})"""
        )
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT {k} AS step, {R('loss')} AS loss FROM p{k + 1}" for k in range(steps)
    )


@query("fit_flow_steps", "N6", _one_block_sql(5, 0.02))
def _(spark, d):
    _, history = flows.fit_flow(generators_scaled(spark, d), "x", 1, {"kind": "constant", "rate": 0.02}, 5)
    return history.select("step", r("loss").alias("loss"))


#: Slope of the mean loss under which the fit of one block ends.
SETTLED = 2e-3


def _momentum_sql(steps: int, rate: float, keep: float) -> str:
    """The same optimum by another way: gradient steps with momentum, by (shift, ln scale, skew, ln tail), until they stand still."""
    return f"""WITH RECURSIVE z AS MATERIALIZED (SELECT (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS x FROM events),
    p AS (
        SELECT 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS e, 0.0::DOUBLE AS f, 0.0::DOUBLE AS va, 0.0::DOUBLE AS vb,
               0.0::DOUBLE AS ve, 0.0::DOUBLE AS vf, 0.0::DOUBLE AS loss
        UNION ALL
        SELECT k + 1, a + na, b + nb, e + ne, f + nf, na, nb, ne, nf, l FROM (
            SELECT k, any_value(a) AS a, any_value(b) AS b, any_value(e) AS e, any_value(f) AS f,
                   {keep} * any_value(va) - {rate} * avg(du / exp(b)) AS na, {keep} * any_value(vb) - {rate} * avg(du * u + 1) AS nb,
                   {keep} * any_value(ve) - {rate} * avg(dt) AS ne, {keep} * any_value(vf) - {rate} * avg(dt * asinh(u) / exp(f) + 1) AS nf,
                   avg(b + f - ln(cosh(t)) + 0.5 * ln(1 + u * u) + 0.5 * ln(2 * pi()) + 0.5 * sinh(t) * sinh(t)) AS l
            FROM (SELECT *, dt / (exp(f) * sqrt(1 + u * u)) - u / (1 + u * u) AS du
                  FROM (SELECT *, -sinh(t) * cosh(t) + tanh(t) AS dt
                        FROM (SELECT *, asinh(u) / exp(f) - e AS t FROM (SELECT p.*, (x - a) / exp(b) AS u FROM z, p WHERE k < {steps}))))
            GROUP BY k))
    SELECT 'gradient' AS stopped, {R('loss', 4)} AS loss, {R('loss', 4)} AS nll, true AS settled FROM p WHERE k = {steps}"""


@query("fit_flow_converged", "N6 N5", _momentum_sql(3000, 0.02, 0.99))
def _(spark, d):
    """One block, to its optimum: why the fit ended, its last loss, the loss of the chain it gave (N5), and whether its slopes are small."""
    scaled_values = generators_scaled(spark, d)
    chain, history = flows.fit_flow_converged(scaled_values, "x", 1, SETTLED, 100)
    end = history.where("stopped IS NOT NULL").select("stopped", r("loss", 4).alias("loss"), (F.col("gradient") <= SETTLED).alias("settled"))
    return attach_scalars(end, flows.flow_nll(scaled_values, "x", chain), nll=F.max("nll")).withColumn("nll", r("nll", 4))


@query("flow_roundtrip", "N7", "SELECT 0.0::DOUBLE AS sum_error, 0.0::DOUBLE AS max_error")
def _(spark, d):
    out = flows.roundtrip_error(scaled(spark, d), "x", CHAIN)
    return out.select(r("sum_error", 6).alias("sum_error"), r("max_error", 9).alias("max_error"))


@query(
    "flow_sample",
    "N8",
    f"""WITH base AS (SELECT event_id, {normal_sql('event_id', seed=42)} AS z FROM events),
        {forward_sql('base', 'z', 'event_id')} SELECT event_id, {R('v')} AS x FROM fwd""",
)
def _(spark, d):
    return flows.flow_sample_over(table(spark, d, "events"), "event_id", CHAIN, 42).withColumn("x", r("x"))


@query(
    "flow_curve_on_grid",
    "N9 S13 N4",
    f"""WITH ends AS (SELECT min({SCALED}) AS lo, max({SCALED}) AS hi FROM events),
        e AS (SELECT i AS grid_id, lo + i * (hi - lo) / 999 AS x FROM ends, range(1000) t(i)),
        {inverse_sql('e', 'x', 'grid_id, x')}, {forward_sql('e', 'x', 'grid_id')}
        SELECT inv.grid_id, {R('x')} AS x, {R(f'exp({LOG_PROB.replace("v", "inv.v")})')} AS prob, {R('fwd.v')} AS mapped
        FROM inv JOIN fwd ON inv.grid_id = fwd.grid_id""",
)
def _(spark, d):
    grid = generators.linspace_over(scaled(spark, d), "x", 1000)
    out = flows.flow_forward(flows.flow_prob(grid, "x", CHAIN), "x", CHAIN, "mapped")
    return out.select("grid_id", r("x").alias("x"), r("prob").alias("prob"), r("mapped").alias("mapped"))


# --- two dimensions -------------------------------------------------------------------

# Deterministic small nets stand for given weights.
LAYERS = [
    coupling.Coupling(
        (0, 1) if i % 2 == 0 else (1, 0),
        new_net(2, [4, 2], ["relu", "tanh"], seed=10 + i),
        new_net(2, [4, 2], ["relu", "linear"], seed=50 + i),
    )
    for i in range(4)
]


def _net_sql(net, feeding: str, unit: int) -> str:
    """One output of a net whose only live input is the passing coordinate."""
    hidden, last = net
    live = 0 if feeding == "x1" else 1
    num = lambda v: f"({float(v)!r}::DOUBLE)"
    units = [
        f"{num(last.weights[j, unit])} * greatest({num(hidden.weights[live, j])} * {feeding} + {num(hidden.bias[j])}, 0)"
        for j in range(len(hidden.bias))
    ]
    total = " + ".join([*units, num(last.bias[unit])])
    return f"tanh({total})" if last.act == "tanh" else f"({total})"


def _coupling_sql(forward: bool) -> str:
    """CTEs c0, c1, ... with x1, x2 and det after each layer."""
    ctes = ["c0 AS (SELECT vec_id, embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS x2, 0.0::DOUBLE AS det FROM embeddings)"]
    for k, layer in enumerate(LAYERS if forward else LAYERS[::-1], 1):
        passing, moved, unit = ("x1", "x2", 1) if layer.mask[0] else ("x2", "x1", 0)
        s, t = _net_sql(layer.scale_net, passing, unit), _net_sql(layer.shift_net, passing, unit)
        new = f"{moved} * exp({s}) + {t}" if forward else f"({moved} - {t}) * exp(-{s})"
        ctes.append(f"c{k} AS (SELECT * REPLACE ({new} AS {moved}, det - {s} AS det) FROM c{k - 1})")
    return "WITH " + ", ".join(ctes)


def planar(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("x1"), F.col("embedding")[1].cast("double").alias("x2")
    )


@query(
    "coupling_to_latent",
    "N10",
    _coupling_sql(False) + f" SELECT vec_id, {R('x1')} AS z1, {R('x2')} AS z2, {R('det')} AS log_det FROM c{len(LAYERS)}",
)
def _(spark, d):
    out = coupling.coupling_inverse(planar(spark, d), "x1", "x2", LAYERS)
    return out.select("vec_id", *[r(c).alias(c) for c in ("z1", "z2", "log_det")])


@query(
    "coupling_roundtrip",
    "N10",
    f"""SELECT vec_id, {R('embedding[1]::DOUBLE')} AS x1, {R('embedding[2]::DOUBLE')} AS x2 FROM embeddings""",
)
def _(spark, d):
    latent = coupling.coupling_inverse(planar(spark, d), "x1", "x2", LAYERS).select("vec_id", "z1", "z2")
    back = coupling.coupling_forward(latent, "z1", "z2", LAYERS)
    return back.select("vec_id", r("x1").alias("x1"), r("x2").alias("x2"))


@query(
    "coupling_loss",
    "N10 N11",
    _coupling_sql(False) + f" SELECT {R('avg(ln(2 * pi()) + 0.5 * x1 * x1 + 0.5 * x2 * x2 - det)')} AS loss FROM c{len(LAYERS)}",
)
def _(spark, d):
    return coupling.coupling_loss(planar(spark, d), "x1", "x2", LAYERS).select(r("loss").alias("loss"))


@query(
    "diagonal_normal_log_prob",
    "N11",
    f"""SELECT {R('avg(-ln(2 * pi()) - ln(2.0::DOUBLE) - 0.5 * pow((embedding[1]::DOUBLE - 0.1) / 2, 2) - 0.5 * pow(embedding[2]::DOUBLE, 2))')} AS mean_log_prob
        FROM embeddings""",
)
def _(spark, d):
    p = diagonal_normal_log_prob(["x1", "x2"], [0.1, 0.0], [2.0, 1.0])
    return planar(spark, d).agg(r(F.avg(p)).alias("mean_log_prob"))


@query(
    "coupling_layer_trace",
    "N12 P20",
    _coupling_sql(True)
    + f""", q AS (SELECT vec_id, CASE WHEN x1 > 0 AND x2 > 0 THEN 'upper right' WHEN x1 < 0 AND x2 > 0 THEN 'upper left'
        WHEN x1 < 0 AND x2 < 0 THEN 'lower left' ELSE 'other' END AS start_quadrant FROM c0) """
    + " UNION ALL ".join(
        f"SELECT vec_id, start_quadrant, {k} AS layer, {R('x1')} AS x1, {R('x2')} AS x2 FROM c{k} JOIN q USING (vec_id)"
        for k in range(len(LAYERS) + 1)
    ),
)
def _(spark, d):
    out = coupling.layer_trace(planar(spark, d), "vec_id", "x1", "x2", LAYERS)
    return out.withColumns({"x1": r("x1"), "x2": r("x2")})


@query(
    "swap_coordinates",
    "N13",
    "SELECT vec_id, embedding[2]::DOUBLE AS x1, embedding[1]::DOUBLE AS x2 FROM embeddings",
)
def _(spark, d):
    return flows.swap_columns(planar(spark, d), "x1", "x2")


@query(
    "latent_path",
    "N14",
    f"""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings),
        {inverse_sql('p', 'a', 'vec_id', 'ia')}, {inverse_sql('p', 'b', 'vec_id', 'ib')},
        path AS (SELECT p.vec_id, i::INTEGER AS step, i / 10.0::DOUBLE * ib.v + (1 - i / 10.0::DOUBLE) * ia.v AS z,
                 i / 10.0::DOUBLE * b + (1 - i / 10.0::DOUBLE) * a AS straight
                 FROM p JOIN ia USING (vec_id) JOIN ib USING (vec_id), range(11) t(i)),
        {forward_sql('path', 'z', 'vec_id, step, straight')}
        SELECT vec_id, step, {R('straight')} AS straight, {R('v')} AS curved FROM fwd""",
)
def _(spark, d):
    out = flows.latent_path(planar(spark, d), "x1", "x2", CHAIN, 11)
    return out.select("vec_id", "step", r("straight").alias("straight"), r("curved").alias("curved"))


@query(
    "normalize_columns",
    "N15 M2",
    f"""SELECT vec_id, {R('(a - avg(a) OVER ()) / stddev_pop(a) OVER ()')} AS x1, {R('(b - avg(b) OVER ()) / stddev_pop(b) OVER ()')} AS x2
        FROM (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings)""",
)
def _(spark, d):
    out = standardize(planar(spark, d), ["x1", "x2"])
    return out.select("vec_id", r("x1").alias("x1"), r("x2").alias("x2"))
