"""Vectors as rows of bytes, and exact search of query blocks against blocks of candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def packed(table: DataFrame, id_column: str, vector_column: str, zero: bool, transform=None) -> DataFrame:
    """(vec_id, v) of the vectors that take part, v being their numbers as little-endian doubles.

    A vector takes part if its id and it are not null, it is not empty, all its numbers are finite,
    it is as long as most vectors are (of equally frequent lengths the longest), and, unless ``zero``,
    some number is not 0. Rows with one id count once, with the smallest bytes.
    """
    x = F.transform(F.col(f"`{vector_column}`"), lambda c: c.cast("double"))
    rows = table.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & finite)
    if not zero:
        rows = rows.where(F.exists("x", lambda c: c != 0))
    if transform is not None:
        rows = rows.withColumn("x", F.transform("x", transform))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    wide = lengths[0]["d"] if lengths else 1

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8")
            size = 8 * wide
            starts = pa.py_buffer(np.arange(batch.num_rows + 1, dtype=np.int64) * size)
            v = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, starts, pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), v.cast(pa.binary())], ["vec_id", "v"])

    return (rows.where(F.size("x") == wide).mapInArrow(run, "vec_id long, v binary")
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of doubles."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def blocks_of(column: str, n: Column | int, salt: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(n) if isinstance(n, int) else n).cast("int")


def ranked(found: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each query in ``order``, with their rank."""
    from pyspark.sql.window import Window

    return (found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
            .where(F.col("rank") <= k))
