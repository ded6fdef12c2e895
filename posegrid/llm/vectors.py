"""Vectors as rows of integers, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Components are held to this size, so that sums of squares stay within 64 bits.
LARGEST = 1 << 28


def whole(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of 32-bit integers as rows of 64-bit ones."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype="<i4").reshape(-1, width).astype(np.int64)


def integer_rows(
    df: DataFrame, scale: int, *, id_col: str, vector_col: str, label_col: str
) -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the whole vectors, and their number of components.

    ``v`` holds floor(scale * x) of every component as little-endian 32-bit
    integers.  The number of components is that of the least id's vector (ties:
    the least vector); vectors of another length cannot be compared and are left
    out, as are null ones and those with a null or non-finite component.  One
    beyond ``LARGEST`` once scaled is an error.  Without any vector the width is 0.
    """
    kept = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    ).where(whole("x") & (F.size("x") > 0))
    least = kept.select("vec_id", F.size("x").alias("n"), "x").orderBy(F.asc_nulls_last("vec_id"), "x").first()
    width = least["n"] if least else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(2).flatten()).reshape(-1, width)
            scaled = np.floor(x * scale)
            if scaled.size and np.abs(scaled).max() > LARGEST:
                raise ValueError(f"a vector's component times {scale} is beyond {LARGEST}")
            v = [row.tobytes() for row in scaled.astype("<i4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(v, type=pa.binary())], names=["vec_id", "label", "v"]
            )

    schema = T.StructType([*kept.schema.fields[:2], T.StructField("v", T.BinaryType())])
    return kept.where(F.size("x") == width).mapInArrow(run, schema), width
