"""Row-wise operators work unchanged on a streaming DataFrame."""

import math

from pyspark.sql import functions as F

from curvelake import streaming
from curvelake.models.flows import Block


def test_row_wise_operators_on_a_stream(spark, sf_dir, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(str(source))
    schema = spark.read.parquet(str(source)).schema
    stream = spark.readStream.schema(schema).parquet(str(source))
    scaled = stream.select("event_id", ((F.col("value") - 100) / 100).alias("x"))
    scored = streaming.flow_log_prob(scaled, "x", [Block(0.1, 1.2, 0.1, 0.9)])
    q = scored.writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    batch = streaming.flow_log_prob(
        spark.read.parquet(str(source)).select("event_id", ((F.col("value") - 100) / 100).alias("x")),
        "x",
        [Block(0.1, 1.2, 0.1, 0.9)],
    )
    got, want = spark.table("scored").agg(F.count("*"), F.sum("log_prob")).first(), batch.agg(F.count("*"), F.sum("log_prob")).first()
    assert got[0] == want[0] and math.isclose(got[1], want[1], rel_tol=1e-9)
