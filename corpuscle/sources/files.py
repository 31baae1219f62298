"""Raw files and manifests."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text as T

BYTE_ORDER_MARK = "﻿"


def binary_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """One row per file below ``paths``: path, modificationTime, length, content.

    Takes any URI the session's Hadoop file systems know.  With ``glob`` only files
    whose name matches are listed; the others are never opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)


# Suffixes in either case: a Hadoop glob has no flag for that.
DOCUMENT_GLOB = "*.{[pP][dD][fF],[tT][xX][tT]}"


def document_files(spark: SparkSession, root: str) -> DataFrame:
    """The ``.pdf`` and ``.txt`` files below a folder, whatever the case of the suffix.

    ``root`` may also be one file; that is taken whatever its name.
    """

    def plain(path: str) -> str:
        return re.sub("^[a-z0-9]+:/*", "/", path).rstrip("/")

    first = binary_files(spark, root).select("path").first()  # no content is read for it
    if first is not None and plain(first.path) == plain(root):
        return binary_files(spark, root)
    return binary_files(spark, root, DOCUMENT_GLOB)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with ``line_at``, a struct that sorts them in file order."""
    read = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    at = F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("row"))
    return read.select("value", at.alias("line_at"))


def manifest(spark: SparkSession, path: str, max_docs: int | None = None) -> DataFrame:
    """Document paths, one per line: byte-order marks dropped, trimmed, blanks left out."""
    entry = T.edge_trim(F.replace("value", F.lit(BYTE_ORDER_MARK), F.lit("")))
    entries = lines(spark, path).select(entry.alias("uri"), "line_at").where(T.has_text(F.col("uri")))
    if max_docs is not None:
        entries = entries.orderBy("line_at").limit(max_docs)
    return entries.select("uri")


def file_text(path: Column, content: Column, pdf_text: Callable[[Column], Column] | None = None) -> Column:
    """Text of a file: UTF-8, or what ``pdf_text`` makes of the bytes of a PDF.

    ``pdf_text`` takes and returns a column, so it may be a pandas UDF.  Without
    one a PDF has no text, as one that cannot be read.
    """
    extracted = pdf_text(F.when(T.is_pdf(path), content)) if pdf_text else F.lit("")
    return F.when(T.is_pdf(path), F.coalesce(extracted, F.lit(""))).otherwise(T.decode_utf8(content))
