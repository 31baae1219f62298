"""Content hashes, ids built from them, and the shard function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def chunk_key(file_name: Column, chunk: Column) -> Column:
    """``file#`` and the first 12 hex digits of the chunk's hash."""
    return F.concat(file_name, F.lit("#"), F.substring(sha256(chunk), 1, 12))


def string_hash(text: Column) -> Column:
    """31-polynomial hash over UTF-16 units modulo 2^32, the one of Java strings.

    Spark's own ``hash`` is Murmur3 and would place documents elsewhere.
    """
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))
    return F.aggregate(
        units,
        F.lit(0).cast("long"),
        lambda acc, unit: (acc * 31 + F.conv(unit, 16, 10).cast("long")).bitwiseAND(F.lit(0xFFFFFFFF)),
    )


def shard_of(doc_id: Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("shards must be at least 1")
    return (string_hash(doc_id).bitwiseAND(F.lit(0x7FFFFFFF)) % shards).cast("int")
