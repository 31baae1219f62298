"""Insert-only upsert into a Parquet table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.keyfilter import add_filters, files_to_open
from corpuscle.session import stage

VERSION_KEY = ["docId", "contentHash"]


def unmatched(incoming: DataFrame, existing: DataFrame, keys: list[str] = VERSION_KEY) -> DataFrame:
    """Incoming rows whose key the table does not hold; a null key never matches."""
    return incoming.join(existing.select(*keys), keys, "left_anti").select(*incoming.columns)


def merged_view(existing: DataFrame, incoming: DataFrame, keys: list[str] = VERSION_KEY) -> DataFrame:
    """What the table holds after the upsert: old versions stay, new ones come in."""
    return existing.unionByName(unmatched(incoming, existing, keys))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table lies at ``path``.

    Only a missing path counts as absent.  Any other failure is raised: taking
    it for an empty table would overwrite the data that is there.
    """
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def upsert(incoming: DataFrame, path: str, keys: list[str] = VERSION_KEY) -> None:
    """Create the table at ``path`` or append the versions it does not hold yet.

    An insert-only merge never rewrites rows, so appending is all there is to
    do.  Running it again after a failure adds only what is still missing.  One
    writer at a time.

    The incoming rows are worked out once and written to the shared folder.  Keys
    alone are compared with the table, and only those of files whose filter does not rule
    all of them out; the new ones then pick the rows to append, so no text is shuffled
    to find out that nothing changed.
    """
    spark = incoming.sparkSession
    if not table_exists(spark, path):
        incoming.write.mode("overwrite").parquet(path)
        return
    staged = stage(incoming, "incoming")
    there = files_to_open(staged, path, keys)
    existing = spark.read.parquet(*[f"{path}/{f}" for f in there]) if there else staged.limit(0)
    new_keys = stage(unmatched(staged.select(*keys), existing, keys).distinct(), "new-keys")
    if new_keys.isEmpty():
        return
    named = new_keys.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    # A null key is new by definition and must find itself again.
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_new_{key}")) for key in keys])
    staged.join(named, same, "left_semi").write.mode("append").parquet(path)
    add_filters(spark, path, keys)
