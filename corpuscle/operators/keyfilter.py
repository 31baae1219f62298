"""Which files of a table may hold a key: a range and a Bloom filter per file, kept beside them.

The filters lie in a folder that readers of the table skip.  A file without one, as a writer
that failed has left it, may hold any key, and gets its filter with the next files.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_key_filters"
BITS, HASHES = 12, 8  # of a filter, for each key: one key in three hundred seems to be there and is not
MOST_KEYS = 1_000_000  # incoming keys sent to the tasks that test filters; with more, every file is opened
SCHEMA = "file string, n long, low string, high string, bits binary"


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key: two halves of its hash in arithmetic progression."""
    h = hashes.view(np.uint64)
    first, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = max(64, 8 * math.ceil(BITS * len(hashes) / 8))
    held = np.zeros(bits, dtype=np.uint8)
    held[_places(hashes, bits).ravel()] = 1
    return np.packbits(held).tobytes()


def may_hold(raw: bytes, hashes: np.ndarray) -> np.ndarray:
    held = np.unpackbits(np.frombuffer(raw, dtype=np.uint8))
    return held[_places(hashes, len(held))].all(axis=1)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a table that is not partitioned."""
    return sorted({f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()})


def key_filters(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(f"{path}/{FOLDER}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def add_filters(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Filters for the files of the table at ``path`` that have none; returns how many there were.

    Of these files the key columns alone are read.  What comes together is the hashes of one
    file, which its writer had in one task too.
    """
    known = key_filters(spark, path)
    have = {r["file"] for r in known.select("file").collect()} if known is not None else set()
    missing = [f for f in files_of(spark, path) if f not in have]
    if not missing:
        return 0
    rows = spark.read.parquet(*[f"{path}/{f}" for f in missing])
    hashed = rows.select(F.col("_metadata.file_name").alias("file"), key_hash(keys).alias("h"), F.col(keys[0]).cast("string").alias("k"))

    def build(table: pa.Table) -> pa.Table:
        bounds = pc.min_max(table.column("k"))
        row = [table.column("file")[0].as_py(), table.num_rows, bounds["min"].as_py(), bounds["max"].as_py(), bloom(table.column("h").to_numpy())]
        return pa.table([[v] for v in row], schema=pa.schema(
            [("file", pa.string()), ("n", pa.int64()), ("low", pa.string()), ("high", pa.string()), ("bits", pa.binary())]))

    # A file without rows has no group, and its filter no bits.
    listed = spark.createDataFrame([(f,) for f in missing], "file string").join(hashed.groupBy("file").applyInArrow(build, SCHEMA), "file", "left")
    listed.coalesce(1 + len(missing) // 64).write.mode("append").parquet(f"{path}/{FOLDER}")
    return len(missing)


def files_to_open(incoming: DataFrame, path: str, keys: list[str]) -> list[str]:
    """Files of the table at ``path`` that may hold a key of ``incoming``.

    Only hashes of the incoming keys, and of the first key its text, are brought together, if
    they are at most ``MOST_KEYS``; else the answer is every file.
    """
    spark = incoming.sparkSession
    every, filters = files_of(spark, path), key_filters(spark, path)
    if filters is None:
        return every
    wanted = incoming.select(key_hash(keys).alias("h"), F.col(keys[0]).cast("string").alias("k")).distinct().limit(MOST_KEYS + 1).toArrow()
    if wanted.num_rows > MOST_KEYS:
        return every
    hashes, texts = wanted.column("h").to_numpy(), np.array([k or "" for k in wanted.column("k").to_pylist()], dtype=object)
    order = np.argsort(texts)
    hashes, texts = hashes[order], texts[order]

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, low, high, raw in zip(*(batch.column(c).to_pylist() for c in ("file", "low", "high", "bits"))):
                # Keys outside the range are not there; a file of null keys has no range.
                a, b = (0, len(texts)) if low is None else (np.searchsorted(texts, low), np.searchsorted(texts, high, "right"))
                if raw and b > a and may_hold(raw, hashes[a:b]).any():
                    found.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["file"])

    tested = {r["file"] for r in filters.select("file").collect()}
    maybe = {r["file"] for r in filters.mapInArrow(test, "file string").collect()}
    return [f for f in every if f in maybe or f not in tested]
