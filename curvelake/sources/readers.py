"""Reading files, tables and text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ColumnLike, as_col, quoted


def list_files(spark: SparkSession, folder: str, suffix: str | None = None) -> DataFrame:
    """Path, size and modification time of every file under a folder.

    The content column of the source is not selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def head_text(spark: SparkSession, path: str, max_bytes: int = 65536) -> DataFrame:
    """Lines of the first ``max_bytes`` bytes of a text file, cut at the last full line.

    A preview: at most ``max_bytes`` lines can fit, and ``take`` reads the file from its start
    and stops as soon as it has enough.
    """
    lines = spark.read.text(path).select(
        F.substring("value", 1, max_bytes).alias("line"),
        F.octet_length("value").cast("long").alias("size"),
    )
    kept, used, wanted = [], 0, 64
    while True:
        rows = lines.take(min(wanted, max_bytes))
        kept, used = [], 0
        for row in rows:
            used += row["size"] + 1
            if used > max_bytes:
                break
            kept.append((len(kept), row["line"]))
        if used > max_bytes or len(rows) < wanted or wanted >= max_bytes:
            break
        wanted *= 8
    return spark.createDataFrame(kept, "line_no int, line string")


def parse_delimited(df: DataFrame, col: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited lines to text columns; lines equal to the header are left out.

    A plain split: quotes have no meaning. Missing trailing fields become null.
    """
    header = sep.join(names)
    parts = F.split(F.col(quoted(col)), re.escape(sep), -1)
    return df.where(F.col(quoted(col)) != F.lit(header)).select(
        *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    infer: bool = False,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """CSV with text columns, inferred types (one more pass over the data) or a given schema."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_table_path(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Dataset by format name. ``delta`` works where its package is on the class path."""
    return spark.read.format(format).load(path)


def read_glob(spark: SparkSession, path_glob: str, format: str = "parquet") -> DataFrame:
    """Only the part files that match a glob."""
    return spark.read.format(format).load(path_glob)


def from_local(
    spark: SparkSession, rows, schema: str | T.StructType | None = None, view: str | None = None
) -> DataFrame:
    """Small local rows or pandas frame as a DataFrame, registered as a view when named."""
    df = spark.createDataFrame(rows, schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def sql(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """SQL over tables, registered views and the DataFrames given as ``{name}`` in the text."""
    return spark.sql(query, **views)


def column_by_position(df: DataFrame, index: int, type: str = "float", name: str = "value") -> DataFrame:
    """The column at a position, cast."""
    return df.select(F.col(quoted(df.columns[index])).cast(type).alias(name))


# Fixed pattern: the first argument of the heat-layer call in a page's script.
HEAT_POINTS = r"(?s)L\.heatLayer\(\s*(\[\s*\[.*?\]\s*\])"


def extract_points(df: DataFrame, html: ColumnLike, keep: Iterable[str] = ()) -> DataFrame:
    """One row per ``[lat, lon]`` pair of the heat layer in each page."""
    literal = F.regexp_extract(as_col(html), HEAT_POINTS, 1)
    pairs = F.from_json(F.nullif(literal, F.lit("")), "array<array<double>>")
    keep = [F.col(quoted(k)) for k in keep]
    return df.select(*keep, F.posexplode(pairs).alias("point", "pair")).select(
        *keep, "point", F.col("pair")[0].alias("lat"), F.col("pair")[1].alias("lon")
    )
