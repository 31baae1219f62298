"""The ingest job as a stream of arriving files (an extension, see README)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpuscle.operators.upsert import upsert
from corpuscle.plans.ingest import docs_from_files

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

# A batch names its files one by one, and Spark lists them again, in a task for each unless told otherwise.
# It reads as many small files in a task as come to a core: with 4 MB for opening each, a task would get 32.
LISTING = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "32", "spark.sql.sources.ignoreDataLocality": "true",
           "spark.sql.files.openCostInBytes": "65536"}


def _listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` and ``LISTING``; ``spark`` itself stays as it is."""
    session = spark.newSession()
    for name, value in {**spark.conf.getAll, **LISTING}.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def file_stream(spark: SparkSession, raw_dir: str, files_per_trigger: int = 10_000) -> DataFrame:
    return (
        _listing_session(spark).readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(raw_dir)
    )


def ingest_stream(
    files: DataFrame, table: str, checkpoint: str, pdf_text: Callable[[Column], Column] | None = None
) -> StreamingQuery:
    """Upsert the files that have arrived, then stop.

    A batch that is run again after a failure inserts only what the table does
    not hold, so nothing is doubled.
    """

    def absorb(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, table)

    docs = docs_from_files(files, pdf_text)
    return (
        docs.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
