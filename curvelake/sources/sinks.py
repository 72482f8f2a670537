"""Writing datasets and working with the catalog."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from .readers import list_files


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    format: str = "parquet",
    max_records_per_file: int = 0,
) -> None:
    """Dataset with one directory per value of the ``by`` columns.

    Each task writes into the directories it meets, so a value with a third of all rows
    is written by many tasks and needs no shuffle; ``compact`` joins small files later.
    """
    writer = df.write.format(format).mode(mode).partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def save_managed(df: DataFrame, name: str, mode: str = "overwrite", format: str = "parquet") -> None:
    df.write.format(format).mode(mode).saveAsTable(name)


def register_external(
    spark: SparkSession, name: str, path: str, format: str = "parquet", partitioned: bool = False
) -> None:
    """Table over existing files. Partition directories count only after the repair."""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING {format} LOCATION '{location}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop if present. Files of a managed table go with it, files of an external one stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """(Re-)register a temp view. A view keeps the plan it was registered with: after a
    derived column is added, register again to make SQL see it."""
    df.createOrReplaceTempView(name)
    return df


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    """Format, location, partition columns, file count, bytes and number of partitions of a table."""
    info = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
    location = info["location"]
    # An empty partition list (typed, since a local row of an empty list has no type).
    parted = info.get("partition_columns") or []
    columns = F.array(*[F.lit(c) for c in parted]).cast("array<string>")
    partitions = spark.sql(f"SHOW PARTITIONS {name}").count() if parted else 0
    return list_files(spark, location, ".parquet" if info["provider"] == "parquet" else None).agg(
        F.lit(info["table_name"]).alias("name"),
        F.lit(info["provider"]).alias("format"),
        F.lit(location).alias("location"),
        columns.alias("partition_columns"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.lit(partitions).cast("long").alias("partitions"),
    )


def compact(
    spark: SparkSession,
    path: str,
    out_path: str,
    target_bytes: int = 256 * 1024 * 1024,
    by: Sequence[str] = (),
    table: str | None = None,
) -> int:
    """Rewrite a Parquet dataset into files of about ``target_bytes`` in a new folder.

    Readers of the old folder are not disturbed. With ``table`` the table then points to
    the new folder. Returns the number of write tasks. The rows are dealt round-robin, so
    hot partition values are spread over the tasks like all others; with ``by`` the rows
    of a small value are first brought together.
    """
    size = list_files(spark, path, ".parquet").agg(F.sum("size")).first()[0] or 0
    tasks = max(1, math.ceil(size / target_bytes))
    df = spark.read.parquet(path)
    if by:
        # As many slots per value as the value's share of the data asks for.
        share = df.groupBy(*by).count()
        total = share.agg(F.sum("count").cast("double"))
        slots = share.withColumn("_total", total.scalar()).select(
            *[F.col(quoted(b)).alias(f"_key_{i}") for i, b in enumerate(by)],
            F.ceil(F.col("count") / F.col("_total") * F.lit(tasks)).cast("int").alias("_slots"),
        )
        same = [F.col(quoted(b)).eqNullSafe(F.col(f"_key_{i}")) for i, b in enumerate(by)]
        # The row number is set at the scan: files are read the same way when a task is repeated.
        spread = (
            df.withColumn("_row", F.monotonically_increasing_id())
            .join(slots, _all(same), "left")
            .withColumn("_slot", F.col("_row") % F.col("_slots"))
        )
        keys = [F.col(quoted(b)) for b in by]
        df = spread.repartition(tasks, *keys, "_slot").select(*[F.col(quoted(c)) for c in df.columns])
        df.write.mode("errorifexists").partitionBy(*by).parquet(out_path)
    else:
        df.repartition(tasks).write.mode("errorifexists").parquet(out_path)
    if table:
        literal = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(out_path)}")
        # Registered partitions have places of their own: each moves to its folder of the same name.
        known = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] if by else []
        for name in known:
            pairs = [part.split("=", 1) for part in name.split("/")]
            value = lambda v: "null" if v == "__HIVE_DEFAULT_PARTITION__" else literal(unquote(v))
            spec = ", ".join(f"{quoted(unquote(k))} = {value(v)}" for k, v in pairs)
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {literal(f'{out_path}/{name}')}")
        if by:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)
    return tasks


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def write_journal(
    df: DataFrame, path: str, journal: str, mode: str = "overwrite", format: str = "parquet"
) -> None:
    """Write ``df`` and append one row about the write to the journal dataset."""
    df.write.format(format).mode(mode).save(path)
    spark = df.sparkSession
    # Rows are counted from what was written, which reads only file footers for Parquet.
    rows = spark.read.format(format).load(path).agg(F.count("*"))
    files = list_files(spark, path, f".{format}").agg(F.count("*"))
    entry = spark.range(1).select(
        F.current_timestamp().alias("time"),
        F.lit(path).alias("path"),
        F.lit(mode).alias("mode"),
        rows.scalar().alias("rows"),
        files.scalar().alias("files"),
    )
    entry.coalesce(1).write.mode("append").parquet(journal)


def history(spark: SparkSession, journal: str) -> DataFrame:
    """Journal rows, newest first."""
    return spark.read.parquet(journal).orderBy(F.desc("time"))


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views that SQL can see."""
    return spark.sql("SHOW TABLES").select(
        "namespace", F.col("tableName").alias("name"), F.col("isTemporary").alias("temporary")
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the row count of the table."""
    described = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("column_type"))
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return (
        df.agg(F.count("*").alias("row_count"))
        .select("row_count", F.explode(F.array(*described)).alias("c"))
        .select("c.position", "c.column_name", "c.column_type", "row_count")
    )


def to_local(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """Export to pandas. A table above ``max_rows`` is refused: aggregate it first."""
    local = df.limit(max_rows + 1).toPandas()
    if len(local) > max_rows:
        raise ValueError(f"more than {max_rows} rows; aggregate before the export")
    return local
