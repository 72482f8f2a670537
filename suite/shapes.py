"""Joins, aggregations, window-like values and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvelake.functions import scalars as s
from curvelake.operators import aggregates as a
from curvelake.operators import joins, sets, windows
from curvelake.operators.quantiles import exact_quantiles

from .registry import CARS_SQL, R, cars, query, r, table

TOP_MAKERS_SQL = """top AS (
    SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rank FROM part GROUP BY p_brand
    QUALIFY rank <= 7)"""


def top_makers(spark, d):
    return windows.top_groups(table(spark, d, "part"), "p_brand", 7)


# --- joins and lookups ----------------------------------------------------------------

@query(
    "semi_join_top_makers",
    "J1 L3",
    f"WITH {TOP_MAKERS_SQL} SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN (SELECT p_brand FROM top)",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return joins.keep_groups(parts, top_makers(spark, d), ["p_brand"])


@query(
    "lookup_in_list_order",
    "J2 L3",
    f"WITH {TOP_MAKERS_SQL} SELECT p_brand, rank, p_partkey, p_size FROM part JOIN top USING (p_brand) ORDER BY rank DESC, p_partkey",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_brand", "p_partkey", "p_size")
    out = joins.ordered_lookup(parts, top_makers(spark, d), "p_brand", "rank", ["p_partkey"], reverse=True)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "attach_global_scalars",
    "J3 A6",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) - min(CAST(year(o_orderdate) AS INTEGER)) OVER () AS age,
       max(o_totalprice) OVER () AS top_price FROM orders""",
)
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    out = joins.attach_scalars(o, o, first=F.min("y"), top_price=F.max("o_totalprice"))
    return out.select("o_orderkey", (F.col("y") - F.col("first")).alias("age"), "top_price")


@query(
    "attach_group_value",
    "J4 W1",
    "SELECT o_orderkey, o_orderstatus, max(o_totalprice) OVER (PARTITION BY o_orderstatus) AS group_max FROM orders",
)
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return windows.group_max(o, ["o_orderstatus"], "o_totalprice", "group_max").drop("o_totalprice")


@query(
    "repeat_runs",
    "J5",
    "SELECT c_custkey, i::INTEGER AS run FROM customer, range(20) t(i)",
)
def _(spark, d):
    return joins.repeat_runs(table(spark, d, "customer").select("c_custkey"), 20)


@query(
    "local_means_on_grid",
    "J6",
    f"""SELECT g AS grid_id, 10.0 * g AS grid_x, count(*) AS n, {R('avg(l_extendedprice)')} AS mean
        FROM lineitem, range(6) t(g) WHERE abs(l_quantity - 10 * g) <= 5 GROUP BY ALL""",
)
def _(spark, d):
    items = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    near = joins.spread_over_grid(items, [10.0 * i for i in range(6)]).where(F.abs(F.col("l_quantity") - F.col("grid_x")) <= 5)
    out = near.groupBy("grid_id", "grid_x").agg(F.count("*").alias("n"), r(F.avg("l_extendedprice")).alias("mean"))
    return out.withColumn("grid_id", F.col("grid_id").cast("bigint"))


@query(
    "fill_axis_gaps",
    "J7",
    """WITH m AS (SELECT event_type, CAST(floor(value) AS INTEGER) AS v, max(value) AS top FROM events GROUP BY ALL),
       g AS (SELECT DISTINCT event_type FROM m), e AS (SELECT min(v) AS lo, max(v) AS hi FROM m),
       axis AS (SELECT event_type, unnest(generate_series(lo, hi))::INTEGER AS v FROM g, e)
       SELECT event_type, v, top FROM axis LEFT JOIN m USING (event_type, v)""",
)
def _(spark, d):
    e = table(spark, d, "events").select("event_type", F.floor("value").cast("int").alias("v"), "value")
    return joins.fill_axis(e.groupBy("event_type", "v").agg(F.max("value").alias("top")), "v", ["event_type"])


@query(
    "inner_join_counts",
    "J8",
    """SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def _(spark, d):
    joined = joins.equi_join(table(spark, d, "orders"), table(spark, d, "customer"), {"o_custkey": "c_custkey"})
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "left_join_counts",
    "J8",
    """SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
)
def _(spark, d):
    joined = joins.equi_join(table(spark, d, "customer"), table(spark, d, "orders"), {"c_custkey": "o_custkey"}, "left")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


# --- aggregations ---------------------------------------------------------------------

@query("group_count", "A1", "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY ALL")
def _(spark, d):
    return a.group_count(table(spark, d, "orders"), ["o_orderstatus"])


@query(
    "mean_delay_two_keys",
    "A2 P2",
    f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, l_returnflag AS origin, {R('avg(l_quantity)')} AS mean_delay
        FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    items = table(spark, d, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_returnflag").alias("origin"),
        s.lenient_double(F.col("l_quantity").cast("string")).alias("delay"),
    )
    return a.group_mean(items, ["date", "origin"], ["delay"]).select("date", "origin", r("mean_delay").alias("mean_delay"))


@query(
    "mean_price_sorted",
    "A3 L1",
    f"SELECT p_brand, {R('avg(p_retailprice)')} AS mean_price FROM part GROUP BY p_brand ORDER BY p_brand",
)
def _(spark, d):
    out = a.group_mean(table(spark, d, "part"), ["p_brand"], ["p_retailprice"], order=True)
    return out.select("p_brand", r("mean_p_retailprice").alias("mean_price"))


@query(
    "several_aggregates_rounded",
    "A4 P11",
    f"""WITH {CARS_SQL} SELECT CAST(cyl AS VARCHAR) AS ch_cyl, count(*) AS count, round(avg(hp), 0) AS avg_hp,
        round(avg(mpg), 1) AS avg_mpg, min(mpg) AS min_mpg, max(mpg) AS max_mpg FROM cars GROUP BY ALL ORDER BY 1 DESC""",
)
def _(spark, d):
    c = cars(spark, d).withColumn("ch_cyl", s.number_label("cyl"))
    return a.group_stats(
        c,
        ["ch_cyl"],
        count=F.count("*"),
        avg_hp=F.round(F.avg("hp"), 0),
        avg_mpg=F.round(F.avg("mpg"), 1),
        min_mpg=F.min("mpg"),
        max_mpg=F.max("mpg"),
    ).orderBy(F.desc("ch_cyl"))


@query(
    "salary_by_group_year",
    "A5 P4 P6",
    f"""SELECT o_orderstatus AS gender, CAST(year(o_orderdate) AS INTEGER) AS birth_year, count(o_totalprice) AS count,
        {R('avg(o_totalprice)')} AS avg_salary, max(o_totalprice) AS max_salary FROM orders GROUP BY ALL""",
)
def _(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("gender"), s.year_of("o_orderdate").alias("birth_year"), "o_totalprice"
    )
    stats = a.group_stats(
        o, ["gender", "birth_year"], True, count=F.count("o_totalprice"), mean=r(F.avg("o_totalprice")), max=F.max("o_totalprice")
    )
    return s.rename(stats, {"mean": "avg_salary", "max": "max_salary"})


@query(
    "global_count_min_max",
    "A6",
    "SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders",
)
def _(spark, d):
    o = table(spark, d, "orders")
    return a.group_stats(o, [], n=F.count("*"), lo=F.min("o_totalprice"), hi=F.max("o_totalprice"))


@query(
    "two_means_by_maker",
    "A7",
    f"""SELECT p_brand, {R('avg(p_size)')} AS city, {R('avg(p_retailprice / 100)')} AS highway FROM part
        GROUP BY p_brand ORDER BY highway, p_brand""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_brand", F.col("p_size").alias("city"), (F.col("p_retailprice") / 100).alias("highway"))
    out = a.group_mean(parts, ["p_brand"], ["city", "highway"]).orderBy("mean_highway", "p_brand")
    return out.select("p_brand", r("mean_city").alias("city"), r("mean_highway").alias("highway"))


@query(
    "crosstab_year_status",
    "A8 P6",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS birth_year, count(*) FILTER (o_orderstatus = 'F') AS "F",
       count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY ALL""",
)
def _(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("birth_year"), "o_orderstatus")
    return a.crosstab(o, "birth_year", "o_orderstatus")


@query(
    "crosstab_top_makers",
    "A9 J1 J2",
    f"""WITH {TOP_MAKERS_SQL} SELECT p_brand, count(*) FILTER (p_size % 3 = 0) AS "0", count(*) FILTER (p_size % 3 = 1) AS "1",
        count(*) FILTER (p_size % 3 = 2) AS "2", any_value(rank) AS rank FROM part JOIN top USING (p_brand)
        GROUP BY p_brand ORDER BY rank DESC""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_brand", s.number_label(F.col("p_size") % 3).alias("cyl"))
    out = a.crosstab_ordered(parts, "p_brand", "cyl", top_makers(spark, d), "rank", ["0", "1", "2"], reverse=True)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("value_counts", "A10", "SELECT p_type, count(*) AS count FROM part GROUP BY p_type ORDER BY count DESC, p_type")
def _(spark, d):
    return a.value_counts(table(spark, d, "part"), "p_type")


@query(
    "pivot_two_measures",
    "A11 P14",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {R("avg(o_totalprice) FILTER (o_orderstatus = 'F')")} AS "avg_price_F",
        {R("avg(o_totalprice) FILTER (o_orderstatus = 'O')")} AS "avg_price_O",
        max(o_totalprice) FILTER (o_orderstatus = 'F') AS "max_price_F",
        max(o_totalprice) FILTER (o_orderstatus = 'O') AS "max_price_O" FROM orders GROUP BY ALL""",
)
def _(spark, d):
    o = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(
        r(F.avg("o_totalprice")).alias("avg_price"), F.max("o_totalprice").alias("max_price")
    )
    return a.pivot_measures(o, "year", "o_orderstatus", ["avg_price", "max_price"], ["F", "O"])


@query(
    "facet_means",
    "A12",
    f"""WITH {CARS_SQL} SELECT gear, am, cyl, count(*) AS n, {R('avg(mpg)')} AS mean FROM cars GROUP BY ALL""",
)
def _(spark, d):
    return a.facet_stats(cars(spark, d), ["gear", "am"], ["cyl"], n=F.count("*"), mean=r(F.avg("mpg")))


@query(
    "histogram_fixed_width",
    "A13",
    """SELECT l_linestatus, CAST(floor(l_extendedprice / 750) AS BIGINT) AS bin, count(*) AS count,
       floor(l_extendedprice / 750) * 750 AS bin_start, (floor(l_extendedprice / 750) + 1) * 750 AS bin_end
       FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    return a.histogram_width(table(spark, d, "lineitem"), "l_extendedprice", 750.0, by=["l_linestatus"])


HIST30_SQL = """e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders),
    h AS (SELECT least(CAST(floor((o_totalprice - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS count
          FROM orders, e GROUP BY 1),
    hist AS (SELECT i AS bin, lo + i * ((hi - lo) / 30) AS bin_start, lo + (i + 1) * ((hi - lo) / 30) AS bin_end,
             coalesce(count, 0) AS count, n FROM e, range(30) t(i) LEFT JOIN h ON bin = i)"""


@query(
    "histogram_fixed_bins",
    "A14",
    f"WITH {HIST30_SQL} SELECT bin, {R('bin_start')} AS bin_start, {R('bin_end')} AS bin_end, count FROM hist",
)
def _(spark, d):
    h = a.histogram_bins(table(spark, d, "orders"), "o_totalprice", 30)
    return h.select("bin", r("bin_start").alias("bin_start"), r("bin_end").alias("bin_end"), "count")


@query(
    "histogram_bins_by_group",
    "A14",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
       g AS (SELECT DISTINCT event_type FROM events),
       h AS (SELECT event_type, least(CAST(floor((value - lo) / (hi - lo) * 20) AS BIGINT), 19) AS bin, count(*) AS count
             FROM events, e GROUP BY ALL)
       SELECT g.event_type, i AS bin, coalesce(h.count, 0) AS count FROM g CROSS JOIN range(20) t(i)
       LEFT JOIN h ON h.event_type = g.event_type AND h.bin = i""",
)
def _(spark, d):
    return a.histogram_bins(table(spark, d, "events"), "value", 20, by=["event_type"]).select("event_type", "bin", "count")


@query(
    "density_histogram",
    "A15",
    f"""WITH {HIST30_SQL} SELECT bin, {R('count / (n * (bin_end - bin_start))', 12)} AS density FROM hist""",
)
def _(spark, d):
    h = a.density_histogram(table(spark, d, "orders"), "o_totalprice", 30)
    return h.select("bin", r("density", 12).alias("density"))


@query(
    "frequency_polygon",
    "A16",
    """SELECT l_linestatus, floor(l_extendedprice / 750) * 750 + 375 AS mid, count(*) AS count FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    return a.freq_polygon(table(spark, d, "lineitem"), "l_extendedprice", 750.0, by=["l_linestatus"])


BOX_SQL = """q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
        quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY ALL),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q JOIN orders USING (o_orderpriority))"""


@query(
    "box_statistics",
    "A17",
    f"""WITH {BOX_SQL} SELECT o_orderpriority, {R('any_value(q1)')} AS q1, {R('any_value(median)')} AS median, {R('any_value(q3)')} AS q3,
        min(o_totalprice) FILTER (o_totalprice BETWEEN low AND high) AS whisker_low,
        max(o_totalprice) FILTER (o_totalprice BETWEEN low AND high) AS whisker_high,
        count(*) FILTER (NOT o_totalprice BETWEEN low AND high) AS outliers, count(*) AS count FROM f GROUP BY ALL""",
)
def _(spark, d):
    b = a.box_stats(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"])
    return b.withColumns({c: r(c) for c in ("q1", "median", "q3")})


@query(
    "box_outlier_rows",
    "A17",
    """WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
       SELECT doc_id, n_chars FROM documents, q WHERE NOT n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def _(spark, d):
    return a.box_outliers(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars")


@query(
    "stacked_counts",
    "A18",
    f"WITH {CARS_SQL} SELECT cyl, am, count(*) AS count FROM cars GROUP BY ALL",
)
def _(spark, d):
    return a.stacked_counts(cars(spark, d), "cyl", "am")


@query(
    "exact_quantiles_by_group",
    "A19",
    f"""SELECT l_returnflag, {R('quantile_cont(l_extendedprice, 0.025)')} AS lower, {R('quantile_cont(l_extendedprice, 0.25)')} AS quarter,
        {R('quantile_cont(l_extendedprice, 0.975)')} AS upper FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    q = exact_quantiles(
        table(spark, d, "lineitem"), "l_extendedprice", {"lower": 0.025, "quarter": 0.25, "upper": 0.975}, ["l_returnflag"]
    )
    return q.withColumns({c: r(c) for c in ("lower", "quarter", "upper")})


@query(
    "exact_quantiles_global",
    "A19",
    f"""SELECT {R('quantile_cont(value, 0.025)')} AS lower, {R('quantile_cont(value, 0.5)')} AS median,
        {R('quantile_cont(value, 0.975)')} AS upper FROM events""",
)
def _(spark, d):
    q = exact_quantiles(table(spark, d, "events"), "value", {"lower": 0.025, "median": 0.5, "upper": 0.975})
    return q.select(*[r(c).alias(c) for c in q.columns])


@query(
    "mean_and_sd",
    "A20",
    f"""SELECT 'l_quantity' AS feature, {R('avg(l_quantity)')} AS mean, {R('stddev_pop(l_quantity)')} AS sd FROM lineitem
        UNION ALL SELECT 'l_extendedprice', {R('avg(l_extendedprice)')}, {R('stddev_pop(l_extendedprice)')} FROM lineitem""",
)
def _(spark, d):
    out = a.mean_sd(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("feature", r("mean").alias("mean"), r("sd").alias("sd"))


# --- group-relative values and ranks --------------------------------------------------

@query(
    "fraction_within_group",
    "W2",
    f"""WITH {CARS_SQL} SELECT cyl, am, count(*) AS count, {R('count(*) / sum(count(*)) OVER (PARTITION BY cyl)')} AS fraction
        FROM cars GROUP BY cyl, am""",
)
def _(spark, d):
    out = windows.group_fraction(cars(spark, d), "cyl", "am")
    return out.withColumn("fraction", r("fraction"))


@query(
    "last_point_per_series",
    "W3",
    f"""WITH m AS (SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y, {R('avg(o_totalprice)')} AS v FROM orders GROUP BY ALL)
        SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY y DESC) = 1""",
)
def _(spark, d):
    m = table(spark, d, "orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("y")).agg(r(F.avg("o_totalprice")).alias("v"))
    return windows.last_row(m, ["o_orderstatus"], "y", "v")


INDEX_SQL = """m AS (SELECT l_returnflag AS g, CAST(year(l_shipdate) AS INTEGER) AS y, avg(l_extendedprice) AS v
                    FROM lineitem GROUP BY ALL)"""


def _yearly(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("g"), F.year("l_shipdate").alias("y")).agg(
        F.avg("l_extendedprice").alias("v")
    )


@query(
    "index_to_global_base",
    "W4 J3 J4",
    f"""WITH {INDEX_SQL} SELECT g, y, {R('v / nullif(max(CASE WHEN y = (SELECT min(y) FROM m) THEN v END) OVER (PARTITION BY g), 0)', 9)} AS indexed FROM m""",
)
def _(spark, d):
    return windows.index_to_base(_yearly(spark, d), "y", "g", "v", "indexed").select("g", "y", r("indexed", 9).alias("indexed"))


@query(
    "index_to_group_base",
    "W4",
    f"""WITH {INDEX_SQL} SELECT g, y, {R('v / first_value(v) OVER (PARTITION BY g ORDER BY y)', 9)} AS indexed FROM m""",
)
def _(spark, d):
    return windows.index_to_base(_yearly(spark, d), "y", "g", "v", "indexed", "group").select("g", "y", r("indexed", 9).alias("indexed"))


@query(
    "rank_of_groups",
    "W5",
    """SELECT l_partkey, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, l_partkey) AS rank
       FROM lineitem GROUP BY l_partkey""",
)
def _(spark, d):
    return windows.group_ranks(table(spark, d, "lineitem"), "l_partkey")


@query(
    "top_groups",
    "L3 W5",
    f"""SELECT p_brand, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rank
        FROM part GROUP BY p_brand QUALIFY rank <= 7""",
)
def _(spark, d):
    return top_makers(spark, d).withColumn("rank", F.col("rank").cast("bigint"))


# --- set operations -------------------------------------------------------------------

YEAR_BAND_SQL = """b AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS q, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
                       FROM lineitem GROUP BY ALL)"""


@query(
    "band_outline",
    "U1",
    f"""WITH {YEAR_BAND_SQL} SELECT 0 AS side, q AS seq, q, lo AS y FROM b UNION ALL SELECT 1, -q, q, hi FROM b""",
)
def _(spark, d):
    b = table(spark, d, "lineitem").groupBy(F.floor("l_quantity").alias("q")).agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")
    )
    return sets.band_outline(b, "q", "q", "lo", "hi")


@query(
    "stack_tables",
    "U2",
    """SELECT s_acctbal AS balance, 'supplier' AS model FROM supplier UNION ALL SELECT c_acctbal, 'customer' FROM customer""",
)
def _(spark, d):
    both = {
        "supplier": table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance")),
        "customer": table(spark, d, "customer").select(F.col("c_acctbal").alias("balance")),
    }
    return sets.stack(both)


@query(
    "wide_to_long",
    "U3",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS series, l_quantity AS value FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""",
)
def _(spark, d):
    return sets.to_long(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])
