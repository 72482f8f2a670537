"""A pipeline over ``documents``: each stage takes the documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm import lines, packing, rules, secrets, simhash
from curvelake.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot say the fingerprints' components, the forest and the packing.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.filter_documents(docs, "v1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document or line has, up to one word, go; a document without any line left goes.

    A null text has no lines to lose and stays.
    """
    cut = lines.dedup_lines(docs).where(F.coalesce((F.col("_kept") > 0) | ~F.col("_changed"), F.lit(True)))
    return cut.select(*COLUMNS[:4], F.when(F.col("_changed"), F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    clean = secrets.redact(docs.withColumn("n_chars", F.when(F.col("n_chars") == F.length("text"), F.lit(-1)).otherwise(F.col("n_chars"))))
    return clean.select(*COLUMNS[:4], F.when(F.col("n_chars") == -1, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents' token ids fill."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
