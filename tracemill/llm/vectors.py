"""Vector columns as numpy blocks, shared by the operators on embeddings."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracemill.session import spool


def take_part(df: DataFrame, id_col: str, vec_col: str, label_col: str | None = None, zero: bool = True) -> DataFrame:
    """(id, vec[, label]) of the rows that take part, written once.

    Rows with a null id, label or vector, an empty one, or one holding null or
    non-finite components take no part; all-zero vectors only if `zero`. Nor do
    vectors of another length than the table's most frequent (of equally
    frequent ones the longest). Of rows that repeat an id the one with the least
    vector, then the least label, counts.
    """
    label = [F.col(label_col).cast("long").alias("label")] if label_col else []
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), *label)
    known = "id IS NOT NULL AND size(vec) > 0 AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
    rows = rows.filter(known + (" AND label IS NOT NULL" if label_col else ""))
    if not zero:
        rows = rows.filter("exists(vec, x -> x <> 0)")
    sizes = rows.groupBy(F.size("vec").alias("dim")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return rows
    rows = spool(rows.filter(F.size("vec") == most["dim"]), "vectors")
    if rows.groupBy("id").count().filter("count > 1").isEmpty():
        return rows
    least = F.min(F.struct("vec", *[c for c in rows.columns if c == "label"])).alias("least")
    return spool(rows.groupBy("id").agg(least).select("id", "least.*"), "vectors")


def matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """A column of lists of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), dtype=np.float64)


def packed(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array, dtype=kind).tobytes()


def unpacked(data: bytes, kind: str, width: int = 0) -> np.ndarray:
    array = np.frombuffer(data, dtype=kind)
    return array.reshape(-1, width) if width else array
