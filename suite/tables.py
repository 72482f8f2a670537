"""Sources, writers, projections and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from curvelake.functions import scalars as s
from curvelake.operators import sampling
from curvelake.session import scratch_path
from curvelake.sources import generators, readers, sinks

from .draws_sql import normal_sql, uniform_sql
from .registry import CARS_SQL, R, cars, query, r, table


# --- sources --------------------------------------------------------------------------

@query("list_table_files", "S1")
def _(spark, d):
    return readers.list_files(spark, d, ".parquet")


@query(
    "parse_delimited_lines",
    "S3",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, CAST(l_quantity AS VARCHAR) AS delay, l_returnflag AS origin
       FROM lineitem""",
)
def _(spark, d):
    items = table(spark, d, "lineitem")
    lines = items.select(
        F.concat_ws(",", F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_quantity").cast("string"), "l_returnflag").alias("line")
    )
    header = spark.createDataFrame([("date,delay,origin",)], "line string")
    return readers.parse_delimited(header.unionByName(lines), "line", ["date", "delay", "origin"])


@query(
    "csv_inferred",
    "S4",
    """SELECT l_returnflag, count(*) AS n, sum(l_linenumber)::BIGINT AS lines, max(l_quantity) AS max_quantity
       FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    path = scratch_path(spark, "csv")
    table(spark, d, "lineitem").select("l_returnflag", "l_linenumber", "l_quantity").write.option("header", True).csv(path)
    back = readers.read_csv(spark, path, infer=True)
    return back.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"), F.max("l_quantity").alias("max_quantity")
    )


@query(
    "csv_as_text",
    "S5",
    """SELECT p_brand, CAST(p_size AS VARCHAR) AS p_size, count(*) AS n FROM part GROUP BY ALL""",
)
def _(spark, d):
    path = scratch_path(spark, "csv")
    table(spark, d, "part").select("p_brand", "p_size").write.option("header", True).csv(path)
    return readers.read_csv(spark, path).groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))


@query(
    "read_by_format",
    "S6",
    "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS max_price FROM orders GROUP BY ALL",
)
def _(spark, d):
    orders = readers.read_table_path(spark, f"{d}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("max_price"))


@query("read_by_glob", "S7", "SELECT p_type, count(*) AS n FROM part GROUP BY ALL")
def _(spark, d):
    return readers.read_glob(spark, f"{d}/part.par*").groupBy("p_type").agg(F.count("*").alias("n"))


@query(
    "local_rows_lookup",
    "S8 J8",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def _(spark, d):
    names = readers.from_local(spark, [("F", "finished"), ("O", "open")], "code string, status string", "status_names")
    from curvelake.operators.joins import equi_join

    joined = equi_join(table(spark, d, "orders"), names, {"o_orderstatus": "code"}, "left")
    return joined.groupBy("status").agg(F.count("*").alias("n"))


@query(
    "sql_over_views",
    "S9",
    """SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey
       JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name""",
)
def _(spark, d):
    views = {n: table(spark, d, n) for n in ("nation", "region", "customer")}
    text = """SELECT r_name, count(*) AS nations FROM {nation} n JOIN {region} r ON n_regionkey = r_regionkey
              JOIN {customer} c ON c_nationkey = n_nationkey GROUP BY r_name"""
    return readers.sql(spark, text, **views)


@query("column_by_position", "S10", "SELECT CAST(value AS FLOAT) AS waiting FROM events")
def _(spark, d):
    return readers.column_by_position(table(spark, d, "events"), 4, "float", "waiting")


@query(
    "points_from_pages",
    "S11",
    f"""WITH c AS (SELECT c_custkey, (41650 + c_custkey % 371) AS a, (87840 - c_custkey % 307) AS b FROM customer)
       SELECT c_custkey, 0 AS point, a / 1000.0::DOUBLE AS lat, -b / 1000.0::DOUBLE AS lon FROM c
       UNION ALL SELECT c_custkey, 1, (a + 1) / 1000.0::DOUBLE, -(b + 1) / 1000.0::DOUBLE FROM c""",
)
def _(spark, d):
    a, b = F.lit(41650) + F.col("c_custkey") % 371, F.lit(87840) - F.col("c_custkey") % 307
    dec = lambda c: F.format_string("%d.%03d", F.floor(c / 1000), c % 1000)
    page = F.format_string(
        '<script>\nvar heat = L.heatLayer(\n  [[%s, -%s], [%s, -%s]],\n {"blur": 20});\n</script>',
        dec(a), dec(b), dec(a + 1), dec(b + 1),
    )
    pages = table(spark, d, "customer").select("c_custkey", page.alias("html"))
    return readers.extract_points(pages, "html", ["c_custkey"])


@query(
    "sine_noisy",
    "S12",
    f"""SELECT event_id, {R('value * 2 * pi() / 500')} AS x,
        {R(f"3 * sin(value * 2 * pi() / 500) + {normal_sql('event_id', seed=7)}")} AS y FROM events""",
)
def _(spark, d):
    x = F.col("value") * F.lit(2 * 3.141592653589793 / 500)
    out = generators.sine_over(table(spark, d, "events"), "event_id", x, 1.0, 7)
    return out.select("event_id", r("x").alias("x"), r("y").alias("y"))


@query(
    "sine_truth",
    "S12 P22",
    f"SELECT event_id, {R('value * 2 * pi() / 500')} AS x, {R('3 * sin(value * 2 * pi() / 500)')} AS y FROM events",
)
def _(spark, d):
    x = F.col("value") * F.lit(2 * 3.141592653589793) / F.lit(500.0)
    out = generators.sine_over(table(spark, d, "events"), "event_id", x, 0.0, 7)
    return out.select("event_id", r("x").alias("x"), r("y").alias("y"))


@query(
    "linspace_grid",
    "S13",
    f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
        SELECT i AS grid_id, {R('lo + i * (hi - lo) / 999')} AS x FROM e, range(1000) t(i)""",
)
def _(spark, d):
    grid = generators.linspace_over(table(spark, d, "events"), "value", 1000)
    return grid.select("grid_id", r("x").alias("x"))


@query(
    "polynomial_curve",
    "S14",
    f"""SELECT l_orderkey, l_linenumber, {R('5 + 10 * x - 3 * x * x + 6 * x * x * x')} AS y
        FROM (SELECT l_orderkey, l_linenumber, l_quantity / 5 AS x FROM lineitem)""",
)
def _(spark, d):
    y = generators.polynomial(F.col("l_quantity") / 5, generators.TEST_POLYNOMIAL)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r(y).alias("y"))


def _rounded(df, *names):
    return df.withColumns({n: r(n) for n in names})


@query(
    "two_moons_sample",
    "S15",
    f"""WITH u AS (SELECT event_id, {uniform_sql('event_id', 0, seed=1)} AS side, pi() * {uniform_sql('event_id', 1, seed=1)} AS t,
            0.05 * {normal_sql('event_id', 2, seed=1)} AS w1, 0.05 * {normal_sql('event_id', 3, seed=1)} AS w2 FROM events)
        SELECT event_id, {R('CASE WHEN side < 0.5 THEN cos(t) ELSE 1 - cos(t) END + w1')} AS x1,
            {R('CASE WHEN side < 0.5 THEN sin(t) ELSE 0.5 - sin(t) END + w2')} AS x2,
            CASE WHEN side < 0.5 THEN 0 ELSE 1 END AS moon FROM u""",
)
def _(spark, d):
    return _rounded(generators.two_moons_over(table(spark, d, "events"), "event_id", 0.05, 1), "x1", "x2")


@query(
    "banana_sample",
    "S16",
    f"""WITH u AS (SELECT event_id, 4 * {normal_sql('event_id', 2, seed=1)} AS b, {normal_sql('event_id', 1, seed=1)} AS a FROM events)
        SELECT event_id, {R('(b * b / 4 + a) / 40')} AS x1, {R('b / 40')} AS x2 FROM u""",
)
def _(spark, d):
    return _rounded(generators.banana_over(table(spark, d, "events"), "event_id", 1), "x1", "x2")


@query(
    "uniform_box_sample",
    "S17",
    f"""SELECT event_id, {R(uniform_sql('event_id', 0, seed=1) + ' * 2 - 1')} AS x1,
        {R(uniform_sql('event_id', 1, seed=1) + ' * 2 - 1')} AS x2 FROM events""",
)
def _(spark, d):
    return _rounded(generators.uniform_box_over(table(spark, d, "events"), "event_id", 2, 1), "x1", "x2")


@query(
    "normal_box_sample",
    "S17",
    f"""SELECT event_id, {R(normal_sql('event_id', 0, seed=1))} AS x1, {R(normal_sql('event_id', 1, seed=1))} AS x2 FROM events""",
)
def _(spark, d):
    return _rounded(generators.normal_box_over(table(spark, d, "events"), "event_id", 2, 1), "x1", "x2")


# --- writers and catalog --------------------------------------------------------------

STATUS_SQL = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL"


def _status(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("write_partitioned_back", "K1", STATUS_SQL)
def _(spark, d):
    path = scratch_path(spark, "partitioned")
    sinks.write_partitioned(table(spark, d, "orders"), path, ["o_orderstatus"])
    return _status(spark.read.parquet(path))


@query("external_table_repaired", "K3", STATUS_SQL)
def _(spark, d):
    path, name = scratch_path(spark, "external"), f"ext_{uuid.uuid4().hex}"
    sinks.write_partitioned(table(spark, d, "orders"), path, ["o_orderstatus"])
    sinks.register_external(spark, name, path, partitioned=True)
    return _status(spark.table(name))


@query(
    "view_after_derived_column",
    "K5 S9",
    "SELECT p_size % 3 AS cyl_class, CAST(p_size % 3 AS VARCHAR) AS ch_cyl, count(*) AS n FROM part GROUP BY ALL",
)
def _(spark, d):
    name = f"parts_{uuid.uuid4().hex}"
    parts = sinks.register_view(table(spark, d, "part").withColumn("cyl_class", F.col("p_size") % 3), name)
    sinks.register_view(parts.withColumn("ch_cyl", s.number_label("cyl_class")), name)
    return spark.sql(f"SELECT cyl_class, ch_cyl, count(*) AS n FROM {name} GROUP BY 1, 2")


@query("table_detail_external", "K6 K3")
def _(spark, d):
    path, name = scratch_path(spark, "detail"), f"detail_{uuid.uuid4().hex}"
    sinks.write_partitioned(table(spark, d, "orders"), path, ["o_orderstatus"])
    sinks.register_external(spark, name, path, partitioned=True)
    return sinks.table_detail(spark, name)


@query(
    "table_detail_facts",
    "K6 K3",
    "SELECT 'parquet' AS format, 'o_orderstatus' AS partition_columns, count(DISTINCT o_orderstatus) AS partitions, true AS stored FROM orders",
)
def _(spark, d):
    """What the detail says of a table, but for its name and place: at least one file per partition, and bytes."""
    path, name = scratch_path(spark, "facts"), f"facts_{uuid.uuid4().hex}"
    sinks.write_partitioned(table(spark, d, "orders"), path, ["o_orderstatus"])
    sinks.register_external(spark, name, path, partitioned=True)
    stored = ((F.col("files") >= F.col("partitions")) & (F.col("bytes") > 0)).alias("stored")
    return sinks.table_detail(spark, name).select("format", F.concat_ws(",", "partition_columns").alias("partition_columns"), "partitions", stored)


@query("managed_table", "K2", STATUS_SQL)
def _(spark, d):
    name = f"managed_{uuid.uuid4().hex}"
    sinks.save_managed(table(spark, d, "orders"), name)
    return _status(spark.table(name))


@query("dropped_table_keeps_files", "K4 K3 K10", f"SELECT *, true AS dropped FROM ({STATUS_SQL})")
def _(spark, d):
    """An external table is listed, dropped and no longer listed; its files can still be read."""
    path, name = scratch_path(spark, "dropped"), f"dropped_{uuid.uuid4().hex}"
    sinks.write_parquet(table(spark, d, "orders"), path)
    sinks.register_external(spark, name, path)
    listed = lambda: sinks.list_tables(spark).where(F.col("name") == name).count()
    before = listed()
    sinks.drop_table(spark, name)
    return _status(spark.read.parquet(path)).withColumn("dropped", F.lit(before == 1 and listed() == 0))


HEAD_BYTES = 300


@query(
    "head_of_text",
    "S2",
    f"""WITH t AS (SELECT n_nationkey, n_nationkey || ',' || n_name || ',' || r_name AS line FROM nation JOIN region ON n_regionkey = r_regionkey),
        l AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS line_no, line, sum(strlen(line) + 1) OVER (ORDER BY n_nationkey) AS used FROM t)
        SELECT line_no::INTEGER AS line_no, line FROM l WHERE used <= {HEAD_BYTES}""",
)
def _(spark, d):
    """The first lines of a file of nations with their regions."""
    nations, path = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")), scratch_path(spark, "head")
    lines = nations.orderBy("n_nationkey").select(F.concat_ws(",", "n_nationkey", "n_name", "r_name").alias("value"))
    lines.coalesce(1).write.text(path)
    return readers.head_text(spark, path, HEAD_BYTES)


@query("compact_small_files", "K7", STATUS_SQL)
def _(spark, d):
    path, out = scratch_path(spark, "small"), scratch_path(spark, "compact")
    sinks.write_parquet(table(spark, d, "orders").repartition(24), path)
    sinks.compact(spark, path, out, target_bytes=1 << 20)
    return _status(spark.read.parquet(out))


@query(
    "write_journal_history",
    "K8",
    "SELECT 'overwrite' AS mode, count(*) AS rows FROM orders UNION ALL SELECT 'append', 2 * count(*) FROM orders",
)
def _(spark, d):
    path, journal = scratch_path(spark, "written"), scratch_path(spark, "journal")
    orders = table(spark, d, "orders")
    sinks.write_journal(orders, path, journal)
    sinks.write_journal(orders, path, journal, mode="append")
    return sinks.history(spark, journal).select("mode", "rows")


@query("write_parquet_back", "K9", STATUS_SQL)
def _(spark, d):
    path = scratch_path(spark, "plain")
    sinks.write_parquet(table(spark, d, "orders"), path)
    return _status(spark.read.parquet(path))


@query(
    "table_profile",
    "K11",
    """SELECT i::INTEGER AS position, c AS column_name, t AS column_type, (SELECT count(*) FROM customer) AS row_count
       FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
                    (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) v(i, c, t)""",
)
def _(spark, d):
    return sinks.profile(table(spark, d, "customer"))


@query(
    "bounded_export",
    "K12",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
)
def _(spark, d):
    counts = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return spark.createDataFrame(sinks.to_local(counts, 1000))


# --- projections and scalar functions -------------------------------------------------

@query(
    "select_dotted_names",
    "P1",
    'SELECT p_brand AS "Manufacturer", p_size AS "MPG.city", p_retailprice / 100 AS "MPG.highway" FROM part',
)
def _(spark, d):
    parts = table(spark, d, "part").select(
        F.col("p_brand").alias("Manufacturer"),
        F.col("p_size").alias("MPG.city"),
        (F.col("p_retailprice") / 100).alias("MPG.highway"),
        "p_type",
    )
    return s.select_columns(parts, "Manufacturer", "MPG.city", "MPG.highway")


@query(
    "cast_text_to_double",
    "P2",
    """SELECT l_orderkey, l_linenumber, TRY_CAST(t AS DOUBLE) AS lenient, CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS strict
       FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN 'NA' ELSE CAST(l_quantity AS VARCHAR) END AS t FROM lineitem)""",
)
def _(spark, d):
    text = F.when(F.col("l_linenumber") == 1, "NA").otherwise(F.col("l_quantity").cast("string"))
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        s.lenient_double(text).alias("lenient"),
        s.strict_double(F.col("l_quantity").cast("string")).alias("strict"),
    )


@query(
    "cast_number_to_text",
    "P3",
    """SELECT DISTINCT l_quantity, CAST(l_quantity AS VARCHAR) AS label, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS whole
       FROM lineitem""",
)
def _(spark, d):
    return (
        table(spark, d, "lineitem")
        .select("l_quantity", s.number_label("l_quantity").alias("label"), s.whole_label("l_quantity").alias("whole"))
        .distinct()
    )


@query(
    "rename_columns",
    "P4",
    f"""SELECT o_orderstatus, {R('avg(o_totalprice)')} AS avg_salary, max(o_totalprice) AS max_salary FROM orders GROUP BY ALL""",
)
def _(spark, d):
    stats = table(spark, d, "orders").groupBy("o_orderstatus").agg(
        r(F.avg("o_totalprice")).alias("mean"), F.max("o_totalprice").alias("max")
    )
    return s.rename(stats, {"mean": "avg_salary", "max": "max_salary"})


@query("modulus_column", "P5", "SELECT o_orderkey, o_orderkey % 10 AS mod_10 FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", s.modulus("o_orderkey", 10).alias("mod_10"))


@query("year_of_date", "P6", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS birth_year FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", s.year_of("o_orderdate").alias("birth_year"))


@query(
    "recode_values",
    "P7",
    """SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 'automatic' WHEN 'O' THEN 'manual' ELSE 'other' END AS am_ch
       FROM lineitem""",
)
def _(spark, d):
    code = s.recode("l_linestatus", {"F": "automatic", "O": "manual"}, "other")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", code.alias("am_ch"))


@query(
    "first_token",
    "P8",
    r"SELECT doc_id, nullif(regexp_extract(text, '(\S+)', 1), '') AS maker FROM documents",
)
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", s.first_token("text").alias("maker"))


@query(
    "ratio_and_change",
    "P9",
    f"""SELECT l_orderkey, l_linenumber, {R('l_extendedprice / l_quantity', 8)} AS unit_price,
        {R('(1 - l_discount + l_tax) * 100 - 100')} AS change FROM lineitem""",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        r(s.ratio("l_extendedprice", "l_quantity"), 8).alias("unit_price"),
        r(s.percent_change(1 - F.col("l_discount") + F.col("l_tax"))).alias("change"),
    )


@query(
    "flagged_value",
    "P10",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice ELSE 0 END AS base_price FROM orders""",
)
def _(spark, d):
    flag = s.year_of("o_orderdate") == 1995
    return table(spark, d, "orders").select("o_orderkey", s.flagged_value(flag, "o_totalprice").alias("base_price"))


@query(
    "round_half_up_even",
    "P11",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / 2) AS half_up, round_even(l_quantity / 2, 0) AS half_even,
       round(l_quantity / 8, 1) AS one_digit FROM lineitem""",
)
def _(spark, d):
    half = F.col("l_quantity") / 2
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        s.rounded(half).alias("half_up"),
        s.rounded(half, 0, "even").alias("half_even"),
        s.rounded(F.col("l_quantity") / 8, 1).alias("one_digit"),
    )


@query(
    "log10_axes",
    "P12",
    f"SELECT l_orderkey, l_linenumber, {R('log10(l_quantity)')} AS log_x, {R('log10(l_extendedprice)')} AS log_y FROM lineitem",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", r(s.log10_axis("l_quantity")).alias("log_x"), r(s.log10_axis("l_extendedprice")).alias("log_y")
    )


@query(
    "percent_labels",
    "P13",
    """SELECT o_orderstatus, printf('%.2f%% %s', (max(o_totalprice) / avg(o_totalprice)) * 100 - 100, o_orderstatus) AS label
       FROM orders GROUP BY o_orderstatus""",
)
def _(spark, d):
    change = s.percent_change(F.max("o_totalprice") / F.avg("o_totalprice"))
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(s.percent_label(change, F.col("o_orderstatus")).alias("label"))


@query(
    "row_label_key",
    "P15",
    "SELECT p_partkey, p_name || ' ' || p_partkey AS car_model FROM part",
)
def _(spark, d):
    return s.row_label(table(spark, d, "part"), "car_model", ["p_name", "p_partkey"]).select("p_partkey", "car_model")


@query("filter_equal", "P16", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def _(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_totalprice")


@query(
    "filter_and",
    "P17",
    f"""WITH {CARS_SQL} SELECT l_orderkey, gear, wt, am FROM cars WHERE (wt > 1900 OR wt < 950) AND am = 'F'""",
)
def _(spark, d):
    c = cars(spark, d)
    return c.where(((c.wt > 1900) | (c.wt < 950)) & (c.am == "F")).select("l_orderkey", "gear", "wt", "am")


@query(
    "filter_or",
    "P18",
    f"""WITH {CARS_SQL} SELECT l_orderkey, gear, hp, mpg FROM cars WHERE hp > 45 OR mpg > 50000""",
)
def _(spark, d):
    c = cars(spark, d)
    return c.where((c.hp > 45) | (c.mpg > 50000)).select("l_orderkey", "gear", "hp", "mpg")


@query(
    "having_count",
    "P19",
    "SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand HAVING count(*) >= 75",
)
def _(spark, d):
    from curvelake.operators.aggregates import having_count

    return having_count(table(spark, d, "part"), ["p_brand"], 75)


@query(
    "quadrant_label",
    "P20",
    """SELECT vec_id, CASE WHEN x > 0 AND y > 0 THEN 'upper right' WHEN x < 0 AND y > 0 THEN 'upper left'
       WHEN x < 0 AND y < 0 THEN 'lower left' ELSE 'other' END AS quadrant
       FROM (SELECT vec_id, embedding[1] AS x, embedding[2] AS y FROM embeddings)""",
)
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", s.quadrant(F.col("embedding")[0], F.col("embedding")[1]).alias("quadrant"))


@query(
    "tick_sequence",
    "P21",
    """SELECT DISTINCT l_quantity, unnest(generate_series(10, 36, 4))::DOUBLE + l_quantity AS tick FROM lineitem""",
)
def _(spark, d):
    q = table(spark, d, "lineitem").select("l_quantity").distinct()
    return q.select("l_quantity", (F.explode(s.tick_sequence(10, 36, 4))).alias("t")).select(
        "l_quantity", (F.col("t") + F.col("l_quantity")).alias("tick")
    )


@query(
    "elementary_functions",
    "P22",
    f"""SELECT event_id, {R('sin(value)')} AS s, {R('exp(-value / 100)')} AS e, {R('ln(value)')} AS l,
        {R('sqrt(value)')} AS q, {R('value * value', 4)} AS sq, {R('pow(value, 3)', 2)} AS cube FROM events""",
)
def _(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id",
        r(F.sin(v)).alias("s"),
        r(F.exp(-v / 100)).alias("e"),
        r(s.natural_log(v)).alias("l"),
        r(F.sqrt(v)).alias("q"),
        r(v * v, 4).alias("sq"),
        r(F.pow(v, F.lit(3.0)), 2).alias("cube"),
    )


@query(
    "activations",
    "P23",
    f"""SELECT event_id, {R('tanh(x)')} AS tanh, {R('1 / (1 + exp(-x))')} AS sigmoid, {R('greatest(x, 0)')} AS relu,
        {R('greatest(x, 0) + ln(1 + exp(-abs(x)))')} AS softplus,
        {R('0.001 + ln(1 + exp(0.05 * x))')} AS scale
        FROM (SELECT event_id, (value - 250) / 50 AS x FROM events)""",
)
def _(spark, d):
    e = table(spark, d, "events").withColumn("x", (F.col("value") - 250) / 50)
    return e.select(
        "event_id",
        r(F.tanh("x")).alias("tanh"),
        r(s.sigmoid("x")).alias("sigmoid"),
        r(s.relu("x")).alias("relu"),
        r(s.softplus("x")).alias("softplus"),
        r(s.positive_scale("x")).alias("scale"),
    )


@query(
    "hyperbolic_functions",
    "P24",
    f"""SELECT event_id, {R('sinh(x)')} AS sinh, {R('asinh(x)')} AS asinh
        FROM (SELECT event_id, (value - 250) / 100 AS x FROM events)""",
)
def _(spark, d):
    e = table(spark, d, "events").withColumn("x", (F.col("value") - 250) / 100)
    return e.select("event_id", r(F.sinh("x")).alias("sinh"), r(s.asinh("x")).alias("asinh"))


# --- sorting, heads, samples and splits -----------------------------------------------

@query("sort_rows", "L1", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return sampling.sort_rows(c, F.desc("c_acctbal"), F.asc("c_custkey"))


@query("head_rows", "L2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sampling.head_rows(o, 1000, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("seeded_shuffle", "L4", "SELECT o_orderkey FROM orders")
def _(spark, d):
    return sampling.seeded_shuffle(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 1234)


@query(
    "bootstrap_batch",
    "L5",
    f"""WITH RECURSIVE p AS (SELECT 0 AS k, exp(-0.5::DOUBLE) AS term, exp(-0.5::DOUBLE) AS below
            UNION ALL SELECT k + 1, term * 0.5 / (k + 1), below + term * 0.5 / (k + 1) FROM p WHERE k < 25),
        u AS (SELECT o_orderkey, o_totalprice, {uniform_sql('o_orderkey', 0, seed=42)} AS u FROM orders)
        SELECT o_orderkey, o_totalprice FROM u JOIN p ON u.u > p.below""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sampling.bootstrap_batch(orders, 0.5, 42, "o_orderkey")


@query(
    "tail_split",
    "L6",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(count(*) OVER () * 0.6)
       THEN 'train' ELSE 'validation' END AS part FROM orders""",
)
def _(spark, d):
    return sampling.tail_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.4)


@query(
    "hash_split",
    "L6",
    f"SELECT o_orderkey, CASE WHEN {uniform_sql('o_orderkey', seed=3)} < 0.2 THEN 'validation' ELSE 'train' END AS part FROM orders",
)
def _(spark, d):
    return sampling.hash_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2, 3)


@query(
    "systematic_sample",
    "L7 P5 P16",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0",
)
def _(spark, d):
    # Every tenth id is what this sampling operator does.
    return sampling.systematic_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 10)
