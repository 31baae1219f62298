"""Inputs of the registered queries, all of them derived from the given tables."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.session import fresh_path, spread

SHARDS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select(*columns))


def uri():
    return F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "doc_id", "source", "text").select(uri().alias("uri"), "text")


def index_source(spark: SparkSession, folder: str) -> DataFrame:
    """Id and text of every document, as the index job reads them."""
    return raw_documents(spark, folder).select(H.sha256(F.col("uri")).alias("docId"), "uri", "text")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "embeddings")).select("vec_id", F.col("embedding").alias("vec"))


def label_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector of every label, the query vectors of the search queries."""
    parts = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))  # one entry per dimension
    return means.groupBy("label").agg(F.transform(ordered, lambda e: e.x).alias("query_vec"))


def write_files(spark: SparkSession, folder: str) -> str:
    """One file per web page below a fresh folder, in eight folders: a fixture of many small files."""
    path = fresh_path(spark, "raw-files")
    pages = table(spark, folder, "pages").select((F.col("page_id") % 8).alias("part"), F.coalesce("html", F.lit("")).alias("text"))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        # On a folder of the machine Hadoop starts two processes for every file it creates, to set its rights.
        store.mkdirs(place)
        root = place.toUri().getPath()
        pages.mapInArrow(lambda batches: _put(batches, root), "files long").write.format("noop").mode("overwrite").save()
        return path
    # Tasks put their files in place themselves; else the driver would rename them one by one.
    files = pages.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("maxRecordsPerFile", 1)
    files.partitionBy("part").text(path)
    return path


def _put(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """A file for each row, as Spark's text writer lays them out; a task that is run again writes the same ones."""
    task, files = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").cast(pa.binary())):
            own = f"{root}/part={'__HIVE_DEFAULT_PARTITION__' if part is None else part}"
            os.makedirs(own, exist_ok=True)
            with open(f"{own}/part-{task:05d}-{files:09d}.txt", "wb") as file:
                file.write(text.as_py() + b"\n")
            files += 1
    yield pa.RecordBatch.from_arrays([pa.array([files])], names=["files"])
