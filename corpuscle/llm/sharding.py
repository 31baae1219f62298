"""Extendible hashing: shards of bounded bytes, named by hash-prefix bits.

The directory starts with one bucket.  A bucket over the byte limit is split on the
next bit of the hash of its rows, and only such buckets are; the rest keep the prefix
they have.  Eight bits are looked at per pass: rows of open buckets are summed by the
next eight bits, and the small table of sums yields the first depth at which each of
those prefixes fits.  Column expressions throughout; no Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.common import without
from corpuscle.session import stage

LIMIT = 16 * 1024 * 1024
BITS = 8
HASH_BITS = 64
BROADCAST_ROWS = 100_000


def _bits(depth: int) -> Column:
    """The first ``depth`` bits of a row's hash, as a string of 0 and 1."""
    text = lambda c: F.lpad(F.conv(F.hex(c), 16, 2), HASH_BITS, "0")
    whole = text("h") if depth <= HASH_BITS else F.concat(text("h"), text("h2"))
    return F.substring(whole, 1, depth)


def assign_shards(
    df: DataFrame, key: str = "doc_id", size: Column | None = None, limit: int = LIMIT,
) -> DataFrame:
    """Per row of ``df``: its ``key``, ``n_bytes``, ``shard`` (prefix bits) and ``depth``.

    ``size`` gives the bytes of a row, by default those of column ``text``; null counts
    as 0.  No shard holds more than ``limit`` bytes, unless it is a single row.  The hash
    is the first 64 bits of the MD5 of the key as text (null as an empty one), so a key
    always lands under the same prefix; rows of one key that are too many for a shard are
    told apart by 64 more bits from a row number, and so are split like any others.  An
    empty table gives no rows.  Only ``key`` and sizes are read, whatever else there is.
    """
    return _assigned(df, key, size, limit, F.monotonically_increasing_id()).drop("row").withColumnRenamed("key", key)


def _assigned(df: DataFrame, key: str, size: Column | None, limit: int, row: Column) -> DataFrame:
    """key, n_bytes, shard, depth and ``row``, a number no other row has."""
    size = F.octet_length("text") if size is None else size
    rows = stage(df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("n_bytes"), row.alias("row"),
    ).select(
        "key", "n_bytes", "row",
        F.conv(F.substring(F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")), 1, 16), 16, -10).cast("long").alias("h"),
        F.xxhash64("row").alias("h2"),
    ), "shard-rows")
    open_rows, depth, parts = rows, 0, []
    while True:
        reach = depth + BITS
        sums = open_rows.groupBy(_bits(reach).alias("child")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        levels = sums.withColumn("k", F.explode(F.sequence(F.lit(depth + 1 if depth else 0), F.lit(reach))))
        bucket = Window.partitionBy("k", F.substring("child", F.lit(1), F.col("k")))
        fits = levels.withColumn("fit", (F.sum("bytes").over(bucket) <= limit) | (F.sum("rows").over(bucket) == 1))
        first = F.min(F.when(F.col("fit"), F.col("k")))
        if reach == 2 * HASH_BITS:
            first = F.coalesce(first, F.lit(reach))  # all bits are used up, which row numbers rule out
        found = stage(fits.groupBy("child").agg(first.alias("depth")), "directory")
        done = found.where("depth IS NOT NULL").withColumn("shard", F.substring("child", F.lit(1), F.col("depth")))
        n_done, n_open = found.agg(F.count("depth"), F.count("*") - F.count("depth")).first()
        keyed = open_rows.withColumn("child", _bits(reach))
        parts.append(keyed.join(F.broadcast(done) if n_done <= BROADCAST_ROWS else done, "child").select("key", "n_bytes", "shard", "depth", "row"))
        if not n_open:
            break
        left = found.where("depth IS NULL").select("child")
        open_rows = keyed.join(F.broadcast(left) if n_open <= BROADCAST_ROWS else left, "child", "left_semi").drop("child")
        depth = reach
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def write_shards(df: DataFrame, path: str, key: str = "doc_id", limit: int = LIMIT) -> None:
    """Write the rows of ``df`` below ``path``, one folder per shard, each row once.

    Keys may be null and may repeat: rows are numbered and written, and meet their
    shards by that number.  An input column ``shard`` is replaced.
    """
    rows = stage(without(df, "shard", "__row").withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    shards = _assigned(rows, key, None, limit, F.col("__row")).select(F.col("row").alias("__row"), F.concat(F.lit("s"), "shard").alias("shard"))
    rows.join(shards, "__row").drop("__row").repartition("shard").write.partitionBy("shard").parquet(path)
