"""Registration of queries: name, covered survey rows, Spark function, SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function of (spark, sf_dir). Without SQL only its own tests check it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        COVERS[name] = covers.split()
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded for the comparison; adding 0.0 turns -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def R(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round({expression}, {digits}) + 0.0)"


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part: power, consumption, cylinders, gearbox, gears, weight, model."""
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("l_orderkey"),
        F.col("l_linenumber").alias("gear"),
        F.col("l_quantity").alias("hp"),
        F.col("l_extendedprice").alias("mpg"),
        (F.col("p_size") % 3).alias("cyl"),
        F.col("l_linestatus").alias("am"),
        F.col("p_retailprice").alias("wt"),
        F.col("p_name").alias("car_model"),
        F.col("p_brand").alias("maker"),
    )


CARS_SQL = """cars AS (
    SELECT l_orderkey, l_linenumber AS gear, l_quantity AS hp, l_extendedprice AS mpg, p_size % 3 AS cyl,
           l_linestatus AS am, p_retailprice AS wt, p_name AS car_model, p_brand AS maker
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per customer, in the map's area."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.lit(41.65) + (F.col("c_custkey") % 371) / F.lit(1000.0)).alias("lat"),
        (F.lit(-87.84) + (F.col("c_custkey") % 307) / F.lit(1000.0)).alias("lon"),
    )


POINTS_SQL = """points AS (
    SELECT c_custkey, 41.65::DOUBLE + (c_custkey % 371) / 1000.0::DOUBLE AS lat,
           -87.84::DOUBLE + (c_custkey % 307) / 1000.0::DOUBLE AS lon FROM customer)"""
