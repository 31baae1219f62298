"""Raw files to the docs table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.functions import text as T
from corpuscle.operators.upsert import upsert
from corpuscle.sources.files import binary_files, file_text


def docs_from_text(raw: DataFrame, title_from_raw: bool = False) -> DataFrame:
    """The docs table of ``uri`` and ``text`` columns.

    ``title_from_raw`` takes the first line of the text as it came; the default
    takes it from the sanitised text, where it is the whole text.
    """
    text = T.sanitize(F.col("text"))
    cleaned = raw.select("uri", text.alias("text"), F.col("text").alias("_raw"))
    return cleaned.select(
        "uri",
        "text",
        T.language().alias("language"),
        T.title(F.col("_raw" if title_from_raw else "text"), F.col("uri")).alias("title"),
        H.sha256(F.col("uri")).alias("docId"),
        H.sha256(F.col("text")).alias("contentHash"),
    )


def docs_from_files(files: DataFrame, pdf_text: Callable[[Column], Column] | None = None) -> DataFrame:
    text = file_text(F.col("path"), F.col("content"), pdf_text)
    return docs_from_text(files.select(F.col("path").alias("uri"), text.alias("text")))


def ingest(
    spark: SparkSession, raw_dir: str, table: str, pdf_text: Callable[[Column], Column] | None = None
) -> int:
    """Upsert the files below ``raw_dir`` into the docs table; returns its row count."""
    upsert(docs_from_files(binary_files(spark, raw_dir), pdf_text), table)
    return spark.read.parquet(table).count()
