"""Small helpers the operators share."""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = re.compile(r"\w+")
# Bytes a Python task works on at a time, a single longer row aside.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name starting with `base` that `df` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def text_of(col: Column | str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return WORD.findall(text.lower())


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `limit` bytes, so that what numpy needs besides stays small."""
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def covered(spans: Iterable[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that (kind, start, end) spans cover, in order and apart."""
    starts, ends = [], []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def overlaps(stretches: tuple[list[int], list[int]], a: int, b: int) -> bool:
    """Whether [a, b) shares a place with any of the stretches."""
    starts, ends = stretches
    return bisect_right(ends, a) < bisect_left(starts, b)
