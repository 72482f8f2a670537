"""Rows of numbers in blocks of arrays, for fits that read a table many times.

A table is turned into blocks once and persisted; each step then reads whole arrays instead of turning rows into arrays again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Arrays = Mapping[str, np.ndarray]


def blocks(df: DataFrame) -> DataFrame:
    """One row per Arrow batch of ``df``: the values of each column as the bytes of an array. No column may hold nulls."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = [pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(cells, names=batch.schema.names)

    return df.mapInArrow(packed, ", ".join(f"`{c}` binary" for c in df.columns))


def summed(table: DataFrame, kinds: Mapping[str, type], of: Callable[[Arrays], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of a vector that ``of`` gives per block; the sum is made by Spark. Empty without rows.

    ``kinds`` names the type of each column's numbers.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                part = of({c: np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()})
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(np.asarray(total, float))], names=["k", "v"])

    rows = table.mapInArrow(partial, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["k"]] = r["v"]
    return out
