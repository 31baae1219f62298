"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Work on one piece of a batch stays in the memory of one Python worker.
PIECE_BYTES = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes in ``column``; a longer row stands alone."""
    if not batch.num_rows:
        return
    values = batch.column(column)
    width = 8 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else 4
    raw = np.frombuffer(values.buffers()[1], dtype=f"i{width}")
    ends = raw[values.offset:values.offset + len(values) + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
        upto = min(max(upto, at + 1), batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto


def dense(values) -> tuple[np.ndarray, int]:
    """Codes from 0 for the values of an Arrow or numpy array, and how many there are."""
    coded = (values if isinstance(values, pa.Array) else pa.array(values)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def joint(*columns: tuple[np.ndarray, int]) -> np.ndarray:
    """One integer per row that is equal where all the coded columns are equal."""
    code, size = columns[0]
    for more, count in columns[1:]:
        if size * count >= 2**62:
            code, size = dense(code)
        code, size = code * count + more, size * count
    return code
