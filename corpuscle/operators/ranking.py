"""Dense ids over a whole ordered table without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.session import stage


def with_dense_id(df: DataFrame, order: list, name: str) -> DataFrame:
    """Number all rows from 0 in the given order.

    Rows are range-partitioned on the order, each range numbers its own rows
    and adds the count of the ranges before it.  The ranges are staged, so that
    the counts and the numbering see the same boundaries even when tasks are
    run again.  ``order`` must identify a row, or ties have no fixed order.
    """
    columns = df.columns
    ranges = stage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "dense-id"
    )
    # One row per range: as many as spark.sql.shuffle.partitions, whatever the table holds.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        ranges.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .select(*columns, name)
    )


def first_rows(df: DataFrame, order: list, n: int, name: str) -> DataFrame:
    """The first ``n`` rows in the given order, numbered from 0.

    Only the ``n`` winners are ever brought together.
    """
    head = df.orderBy(*order).limit(n)
    return head.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
