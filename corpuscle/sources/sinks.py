"""Writers of the files the engine hands on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text as T


def write_json_chunks(chunks: DataFrame, path: str) -> None:
    chunks.select("id", "source", "text", "embedding").write.json(path)


def write_csv_index(chunks: DataFrame, path: str) -> None:
    """doc, chunk_idx, chars and the vector as numbers separated by spaces.

    A line end in ``doc`` is written escaped, so that a row is one line and files
    can be split; ``records.csv_index`` turns it back.
    """
    chunks.select(T.escape_lines(F.col("doc")).alias("doc"), "chunk_idx", "chars", T.pack_vector(F.col("vec")).alias("vec")).write.option(
        "header", True
    ).option("escape", '"').csv(path)


def write_csv(table: DataFrame, path: str) -> None:
    """Vocabulary, neighbours, similarity and analogy files."""
    table.write.option("header", True).csv(path)


def write_wide_embeddings(embeddings: DataFrame, path: str, dim: int | None = None) -> None:
    """``token, d0, ...``; the dimension is looked up when not given.

    Line ends in a token are written escaped, commas and quotes the CSV way.
    """
    if dim is None:
        low, high = embeddings.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
        if low != high:
            raise ValueError(f"vectors of {low} to {high} dimensions do not fit one table")
        dim = high or 0
    columns = [F.col("vec")[i].alias(f"d{i}") for i in range(dim)]
    embeddings.select(T.escape_lines(F.col("token")).alias("token"), *columns).write.option("header", True).option(
        "escape", '"'
    ).csv(path)


BUILDS = "_builds"  # one row per finished build of an index; the last one counts


def write_build(index: DataFrame, path: str, rebalance: bool = True) -> str:
    """Write the rows of an index to a folder of their own below ``path`` and return it.

    One directory per shard.  A shard holds a fixed share of the corpus, so it must not
    be one task: the rebalance hint splits its rows into files of even size.  Rows that
    already lie spread over tasks, whatever their shard, can do without.
    """
    build = f"build-{uuid.uuid4().hex}"
    spread = index.hint("rebalance", "shard") if rebalance else index
    spread.write.partitionBy("shard").parquet(f"{path}/{build}/rows")
    return build


def publish_build(spark: SparkSession, path: str, build: str) -> None:
    """Make a finished build the one that readers see; until then they see the one before."""
    done = spark.range(1).select(F.lit(build).alias("build"), F.current_timestamp().alias("at"))
    done.coalesce(1).write.mode("append").parquet(f"{path}/{BUILDS}")


def retire_builds(spark: SparkSession, path: str, earlier: int) -> list[str]:
    """Delete builds but the last and ``earlier`` before it; returns the folders that went.

    Builds that were never published were left by runs that failed, and go too: one writer
    at a time.
    """
    done = [r["build"] for r in spark.read.parquet(f"{path}/{BUILDS}").orderBy(F.desc("at"), "build").collect()]  # one row per build
    kept = set(done[:earlier + 1])
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(place)]
    gone = [n for n in names if n.startswith("build-") and n not in kept]
    for name in gone:
        files.delete(jvm.org.apache.hadoop.fs.Path(place, name), True)
    return gone


def write_sharded_index(index: DataFrame, path: str) -> None:
    """Build the index beside the one that is there, then put it in its place."""
    publish_build(index.sparkSession, path, write_build(index, path))


def write_job_output(table: DataFrame, path: str) -> None:
    """Tab-separated result of a batch job; the folder must not exist yet."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in table.columns])
    table.select(line.alias("value")).write.mode("errorifexists").text(path)
