"""Trend lines, local regression, densities, composed analyses and heat maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvelake.operators import heat, smooth
from curvelake.plans import growth

from .registry import CARS_SQL, POINTS_SQL, R, cars, points, query, r, table


# --- lines and smoothers --------------------------------------------------------------

@query(
    "line_per_group",
    "C1",
    f"""WITH {CARS_SQL} SELECT cyl, {R('regr_slope(mpg, hp)')} AS slope, {R('regr_intercept(mpg, hp)')} AS intercept,
        {R('regr_r2(mpg, hp)')} AS r2, regr_count(mpg, hp)::BIGINT AS n FROM cars GROUP BY cyl""",
)
def _(spark, d):
    out = smooth.group_lm(cars(spark, d), "hp", "mpg", ["cyl"])
    return out.withColumns({c: r(c) for c in ("slope", "intercept", "r2")})


@query(
    "line_band",
    "C2",
    f"""WITH {CARS_SQL}, s AS (SELECT cyl, regr_slope(mpg, hp) AS b, regr_intercept(mpg, hp) AS a, regr_avgx(mpg, hp) AS mx,
            regr_sxx(mpg, hp) AS sxx, regr_syy(mpg, hp) AS syy, count(*) AS n FROM cars GROUP BY cyl),
        g AS (SELECT *, 5.0::DOUBLE * i AS x FROM s, range(11) t(i)),
        h AS (SELECT *, a + b * x AS fit, 1.96 * sqrt((syy - b * b * sxx) / (n - 2) * (1.0 / n + (x - mx) * (x - mx) / sxx)) AS half FROM g)
        SELECT cyl, i AS grid_id, x AS grid_x, {R('fit')} AS fit, {R('fit - half')} AS lower, {R('fit + half')} AS upper FROM h""",
)
def _(spark, d):
    out = smooth.lm_band(cars(spark, d), "hp", "mpg", [5.0 * i for i in range(11)], 1.96, ["cyl"])
    return out.withColumns({c: r(c) for c in ("fit", "lower", "upper")}).withColumn("grid_id", F.col("grid_id").cast("bigint"))


LOESS_SQL = """x AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem),
    g AS (SELECT i, 2.5::DOUBLE * (i + 1) AS gx FROM range(20) t(i)),
    dist AS (SELECT i, gx, x - gx AS u, y, abs(x - gx) AS dd FROM x, g),
    ranked AS (SELECT i, dd, row_number() OVER (PARTITION BY i ORDER BY dd) AS rn, count(*) OVER (PARTITION BY i) AS n FROM dist),
    h AS (SELECT i, dd AS h FROM ranked WHERE rn = CAST(floor(n * {span} + 1e-5) AS BIGINT)),
    w AS (SELECT i, gx, u / h AS u, y, pow(1 - pow(abs(u / h), 3), 3) AS w FROM dist JOIN h USING (i) WHERE dd < h),
    s AS (SELECT i, gx, sum(w) AS s0, sum(w*u) AS s1, sum(w*u*u) AS s2, sum(w*u*u*u) AS s3, sum(w*u*u*u*u) AS s4,
          sum(w*y) AS t0, sum(w*u*y) AS t1, sum(w*u*u*y) AS t2 FROM w GROUP BY ALL)"""


def _loess(spark, d, span, degree):
    cars = table(spark, d, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    out = smooth.loess_grid(cars, "x", "y", [2.5 * (i + 1) for i in range(20)], span, degree)
    return out.select(F.col("grid_id").cast("bigint").alias("grid_id"), "grid_x", r("fit", 5).alias("fit"))


@query(
    "loess_degree_1",
    "C3 J6",
    f"WITH {LOESS_SQL.format(span=0.75)} SELECT i AS grid_id, gx AS grid_x, {R('(s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1)', 5)} AS fit FROM s",
)
def _(spark, d):
    return _loess(spark, d, 0.75, 1)


@query(
    "loess_degree_2",
    "C3 J6",
    f"""WITH {LOESS_SQL.format(span=0.5)} SELECT i AS grid_id, gx AS grid_x,
        {R('''(t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2))
            / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2))''', 5)} AS fit FROM s""",
)
def _(spark, d):
    return _loess(spark, d, 0.5, 2)


@query(
    "kernel_density",
    "C4 J6",
    f"""WITH k AS (SELECT stddev_samp(o_totalprice) * pow(count(*), -0.2) AS bw, count(*) AS n FROM orders)
        SELECT i AS grid_id, 10000.0::DOUBLE * i AS grid_x,
        {R('sum(exp(-0.5 * pow((o_totalprice - 10000.0 * i) / bw, 2))) / (any_value(bw) * any_value(n) * sqrt(2 * pi()))', 12)} AS density
        FROM orders, k, range(50) t(i) GROUP BY i""",
)
def _(spark, d):
    out = smooth.kde_grid(table(spark, d, "orders"), "o_totalprice", [10000.0 * i for i in range(50)])
    return out.select(F.col("grid_id").cast("bigint").alias("grid_id"), "grid_x", r("density", 12).alias("density"))


@query(
    "kernel_density_binned",
    "C4",
    f"""WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 2000 AS step, count(*) AS n FROM orders),
        b AS (SELECT lo + (least(floor((o_totalprice - lo) / step), 1999) + 0.5) * step AS c, count(*) AS w, any_value(n) AS n
              FROM orders, e GROUP BY 1)
        SELECT i AS grid_id, 10000.0::DOUBLE * i AS grid_x,
        {R('sum(w * exp(-0.5 * pow((c - 10000.0 * i) / 9000, 2))) / (9000 * any_value(n) * sqrt(2 * pi()))', 12)} AS density
        FROM b, range(50) t(i) GROUP BY i""",
)
def _(spark, d):
    out = smooth.kde_grid(table(spark, d, "orders"), "o_totalprice", [10000.0 * i for i in range(50)], 9000.0, 2000)
    return out.select(F.col("grid_id").cast("bigint").alias("grid_id"), "grid_x", r("density", 12).alias("density"))


# --- composed analyses ----------------------------------------------------------------

@query(
    "dot_table",
    "C5 A10 P19 J1 A7 L1",
    f"""SELECT p_brand, {R('avg(p_size)')} AS city, {R('avg(p_retailprice / 100)')} AS highway FROM part
        GROUP BY p_brand HAVING count(*) >= 75 ORDER BY highway, p_brand""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_brand", F.col("p_size").alias("city"), (F.col("p_retailprice") / 100).alias("highway"))
    out = growth.dot_table(parts, "p_brand", ["city", "highway"], 75, "highway")
    return out.select("p_brand", r("mean_city").alias("city"), r("mean_highway").alias("highway"))


GROWTH_SQL = """m AS (SELECT o_orderstatus AS g, CAST(year(o_orderdate) AS INTEGER) AS year, count(o_totalprice) AS n, avg(o_totalprice) AS v
        FROM orders GROUP BY ALL HAVING count(o_totalprice) > 500),
    i AS (SELECT *, v / max(CASE WHEN year = (SELECT min(year) FROM m) THEN v END) OVER (PARTITION BY g) AS q FROM m)"""


def _dated(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderstatus").alias("g"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))


@query(
    "indexed_growth",
    "C6 A5 P19 W4 A11 P14",
    "WITH " + GROWTH_SQL + " SELECT year, " + ", ".join(
        f"""{R(f"max({col}) FILTER (g = '{g}')", 6 if name == 'avg_price' else 9)} AS "{name}_{g}" """
        for col, name in (("v", "avg_price"), ("q", "price_to_base"))
        for g in "FOP"
    ) + " FROM i GROUP BY year",
)
def _(spark, d):
    out = growth.indexed_growth(_dated(spark, d), "year", "g", "price", 500, ["F", "O", "P"])
    return out.select("year", *[r(c, 6 if c.startswith("avg") else 9).alias(c) for c in out.columns if c != "year"])


@query(
    "growth_end_labels",
    "C6 W3 P13 P9",
    f"""WITH {GROWTH_SQL} SELECT g, year, {R('q', 9)} AS price_to_base,
        printf('%.2f%% %s', q * 100 - 100, CASE g WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Pending' END) AS label
        FROM i QUALIFY row_number() OVER (PARTITION BY g ORDER BY year DESC) = 1""",
)
def _(spark, d):
    names = {"F": "Finished", "O": "Open", "P": "Pending"}
    return growth.growth_labels(_dated(spark, d), "year", "g", "price", 500, names).withColumn("price_to_base", r("price_to_base", 9))


@query(
    "line_series",
    "C7 A5 L1 P17",
    f"""SELECT o_orderstatus AS g, CAST(year(o_orderdate) AS INTEGER) AS year, {R('avg(o_totalprice)')} AS avg_price
        FROM orders GROUP BY ALL HAVING count(o_totalprice) > 500 ORDER BY ALL""",
)
def _(spark, d):
    return growth.line_series(_dated(spark, d), "year", "g", "price", 500).withColumn("avg_price", r("avg_price"))


# --- heat map -------------------------------------------------------------------------

@query(
    "point_extent",
    "G1",
    f"""WITH {POINTS_SQL} SELECT {R('min(lat)')} AS min_lat, {R('max(lat)')} AS max_lat, {R('min(lon)')} AS min_lon, {R('max(lon)')} AS max_lon,
        {R('avg(lat)')} AS mean_lat, {R('avg(lon)')} AS mean_lon, count(*) AS points FROM points""",
)
def _(spark, d):
    out = heat.extent(points(spark, d), "lat", "lon")
    return out.select(*[r(c).alias(c) if c != "points" else c for c in out.columns])


@query(
    "web_mercator",
    "G2",
    f"""WITH {POINTS_SQL} SELECT c_custkey, {R('6378137 * radians(lon)', 3)} AS mx, {R('6378137 * ln(tan(pi() / 4 + radians(lat) / 2))', 3)} AS my FROM points""",
)
def _(spark, d):
    return heat.web_mercator(points(spark, d), "lat", "lon").select("c_custkey", r("mx", 3).alias("mx"), r("my", 3).alias("my"))


PIXEL_SQL = POINTS_SQL + """, pix AS (SELECT c_custkey, (0.5 + lon / 360) * 256 * 1024 AS fx,
    (0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * 256 * 1024 AS fy FROM points)"""


@query(
    "tile_and_pixel",
    "G3",
    f"""WITH {PIXEL_SQL} SELECT c_custkey, floor(fx)::BIGINT AS px, floor(fy)::BIGINT AS py, floor(fx / 256)::BIGINT AS tile_x,
        floor(fy / 256)::BIGINT AS tile_y FROM pix""",
)
def _(spark, d):
    return heat.tile_pixel(points(spark, d), "lat", "lon").select("c_custkey", "px", "py", "tile_x", "tile_y")


CELLS_SQL = PIXEL_SQL + """, cells AS (SELECT floor(fx / 10)::BIGINT AS cx, floor(fy / 10)::BIGINT AS cy, count(*) AS points FROM pix GROUP BY ALL)"""
SURFACE_SQL = CELLS_SQL + """, o AS (SELECT dx, dy, 10 * sqrt(dx * dx + dy * dy) AS far FROM range(-5, 6) a(dx), range(-5, 6) b(dy)),
    k AS (SELECT dx, dy, CASE WHEN far <= 30 THEN 1.0 ELSE 1 - (far - 30) / 20 END AS w FROM o WHERE far < 50),
    surface AS (SELECT cx + dx AS cx, cy + dy AS cy, sum(points * w) AS weight FROM cells, k GROUP BY ALL)"""


@query("heat_cells", "G4", f"WITH {CELLS_SQL} SELECT * FROM cells")
def _(spark, d):
    return heat.heat_cells(points(spark, d), "lat", "lon", cell_px=10)


@query(
    "heat_pyramid",
    "G3 G4",
    f"""WITH {POINTS_SQL}, w AS (SELECT 0.5 + lon / 360 AS x, 0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi()) AS y FROM points)
        SELECT z::INTEGER AS zoom, floor(x * pow(2, z))::BIGINT AS cx, floor(y * pow(2, z))::BIGINT AS cy, count(*) AS points
        FROM w, range(19) t(z) GROUP BY ALL""",
)
def _(spark, d):
    return heat.heat_pyramid(points(spark, d), "lat", "lon")


@query("heat_surface", "G5", f"WITH {SURFACE_SQL} SELECT cx, cy, {R('weight')} AS weight FROM surface")
def _(spark, d):
    cells = heat.heat_cells(points(spark, d), "lat", "lon", cell_px=10)
    return heat.heat_surface(cells, cell_px=10).withColumn("weight", r("weight"))


@query(
    "heat_opacity",
    "G6 J3",
    f"WITH {SURFACE_SQL} SELECT cx, cy, {R('greatest(weight / max(weight) OVER (), 0.5)')} AS opacity FROM surface",
)
def _(spark, d):
    cells = heat.heat_cells(points(spark, d), "lat", "lon", cell_px=10)
    return heat.heat_opacity(heat.heat_surface(cells, cell_px=10)).select("cx", "cy", r("opacity").alias("opacity"))
