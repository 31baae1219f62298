"""Docs to chunks, vectors and indexes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.functions import text as T
from corpuscle.operators.cells import build_cells
from corpuscle.operators.chunking import chunk, chunk_by_paragraph
from corpuscle.operators.embed import Embedder, embed_column
from corpuscle.operators.upsert import table_exists
from corpuscle.session import stage
from corpuscle.sources.records import docs_table
from corpuscle.sources.sinks import publish_build, retire_builds, write_build, write_csv_index, write_json_chunks

FEW_SHARDS = 16

MakeEmbedder = Callable[[], Embedder]


def index_rows(
    docs: DataFrame,
    shards: int,
    make_embedder: MakeEmbedder | None = None,
    max_chars: int = 800,
    overlap: int = 160,
    batch: int = 16,
    **embedding,
) -> DataFrame:
    """Index records ``shard, doc_id, chunk_id, text, vec`` of a docs table.

    Every version of a document is indexed.  The shard is worked out once per
    document, before the document is cut.
    """
    placed = docs.select(F.col("docId").alias("doc_id"), "text", H.shard_of(F.col("docId"), shards).alias("shard"))
    embedded = embed_column(chunk(placed, "text", max_chars, overlap), make_embedder, batch=batch, **embedding)
    return embedded.select("shard", "doc_id", "chunk_id", "text", "vec", "embed_error")


def reused_rows(
    docs: DataFrame, shards: int, vectors: str, make_embedder: MakeEmbedder | None = None, max_chars: int = 800, overlap: int = 160,
    batch: int = 16, model: str = "default", **embedding,
) -> DataFrame:
    """``index_rows``, with vectors kept in the table at ``vectors`` under the hash of their chunk.

    Only texts that have no vector of that ``model`` yet reach the embedder, each once, and
    theirs are added to the table.  To find them hashes are compared, not texts.  A text
    the model fails on is tried again in the next run.
    """
    placed = docs.select(F.col("docId").alias("doc_id"), "text", H.shard_of(F.col("docId"), shards).alias("shard"))
    # Cut again whenever they are needed: writing and reading them costs more.
    chunks = chunk(placed, "text", max_chars, overlap).withColumn("hash", H.sha256(F.col("text")))
    spark = docs.sparkSession
    kept = "model string, hash string, vec array<float>"
    hashes = chunks.select("hash").distinct()
    if table_exists(spark, vectors):
        have = spark.read.schema(kept).parquet(vectors).where(F.col("model") == model)
        hashes = hashes.join(have.select("hash"), "hash", "left_anti")
    hashes = stage(hashes, "unknown-chunks")
    errors = None
    if not hashes.isEmpty():
        unknown = chunks.join(hashes, "hash", "left_semi").groupBy("hash").agg(F.first("text").alias("text"))
        embedded = stage(embed_column(unknown, make_embedder, batch=batch, **embedding).drop("text"), "new-vectors")
        embedded.where(F.col("vec").isNotNull()).select(F.lit(model).alias("model"), "hash", "vec").write.mode("append").parquet(vectors)
        errors = embedded.where(F.col("vec").isNull()).select("hash", "embed_error")
    have = spark.read.schema(kept).parquet(vectors).where(F.col("model") == model) if table_exists(spark, vectors) else None
    found = chunks.withColumn("vec", F.lit(None).cast("array<float>")) if have is None else chunks.join(
        have.groupBy("hash").agg(F.first("vec").alias("vec")), "hash", "left")
    found = found.withColumn("embed_error", F.lit(None).cast("string")) if errors is None else found.join(errors, "hash", "left")
    rows = found.select("shard", "doc_id", "chunk_id", "text", "vec", "embed_error")
    # Without any chunk written, as rows count themselves and a plan that turns out empty would not.
    return stage(rows, "index-rows") if chunks.isEmpty() else rows


class TooManyFailures(RuntimeError):
    """More texts than allowed got no vector; nothing was published."""


def _counts(rows: DataFrame, vec: str) -> tuple[DataFrame, Observation]:
    """Rows that count themselves as they are written."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("prepared"), F.count(vec).alias("embedded")), seen


def _checked(seen: Observation, max_failed: float) -> dict[str, int]:
    counts = {"prepared": seen.get["prepared"], "embedded": seen.get["embedded"]}
    counts["failed"] = counts["prepared"] - counts["embedded"]
    if counts["failed"] > max_failed * counts["prepared"]:
        raise TooManyFailures(f"{counts['failed']} of {counts['prepared']} texts got no vector")
    return counts


def build_index(
    spark: SparkSession, table: str, path: str, shards: int, make_embedder: MakeEmbedder | None = None,
    max_failed: float = 0.1, metric: str | None = None, cells: int | None = None, reuse: bool = False, earlier: int | None = None,
    **options,
) -> dict[str, int]:
    """Write the sharded index of the docs table; returns texts prepared, embedded and failed.

    Texts without a vector stay out.  If they are more than the share ``max_failed``
    of all, ``TooManyFailures`` is raised and readers keep the index that was there, as
    they do until the new one is complete.  With ``metric`` the index is also split into
    cells for that metric, and ``answer.retrieve_from`` then reads only the cells near
    a question.

    With ``reuse`` vectors are kept beside the builds, and only chunks that no run has seen
    reach the model.  With ``earlier`` that many builds before the new one stay for readers
    that still use them, and older and broken ones are deleted.
    """
    docs = docs_table(spark, table)
    made = reused_rows(docs, shards, f"{path}/_vectors", make_embedder, **options) if reuse else index_rows(docs, shards, make_embedder, **options)
    rows, seen = _counts(made, "vec")
    # Reused vectors have been joined by the hash of their chunk, so each task holds an even part of every shard.
    build = write_build(rows.where(F.col("vec").isNotNull()).drop("embed_error"), path, rebalance=not reuse or shards > FEW_SHARDS)
    counts = _checked(seen, max_failed)
    if metric is not None:
        written = spark.read.parquet(f"{path}/{build}/rows")
        build_cells(answerable(written), f"{path}/{build}/cells", ["doc_id", "chunk_order"], metric=metric, cells=cells)
    publish_build(spark, path, build)
    if earlier is not None:
        retire_builds(spark, path, earlier)
    return counts


def answerable(index: DataFrame) -> DataFrame:
    """Index rows as retrieval takes them: those with text, missing ids named."""
    return index.where(T.has_text(F.coalesce("text", F.lit("")))).select(
        "shard",
        F.coalesce("doc_id", F.lit("unknown.pdf")).alias("doc_id"),
        # The id decides between equal scores, so it stays a number next to its printed form.
        F.coalesce("chunk_id", F.lit(-1)).alias("chunk_order"),
        F.coalesce(F.col("chunk_id").cast("string"), F.lit("?")).alias("chunk_id"),
        "text",
        "vec",
    )


def chunk_records(
    files: DataFrame,
    make_embedder: MakeEmbedder | None = None,
    by_paragraph: bool = False,
    min_chars: int = 120,
    separator: str = r"\n{2,}",
) -> DataFrame:
    """Chunks of ``name`` and ``text`` rows as ``id, source, text, embedding``.

    Short and corrupted chunks are left out.  ``by_paragraph`` packs the
    paragraphs of the raw text instead of cutting windows of the sanitised one.
    A null ``embedding`` marks a chunk the model failed on, with the reason.
    """
    # Files whose sanitised text is empty have nothing to cut, so they are not read further.
    named = files.select(F.col("name").alias("source"), "text").where(T.sanitizes_to_text(F.col("text")))
    if by_paragraph:
        chunks = chunk_by_paragraph(named, min_len=min_chars, separator=separator)
    else:
        chunks = chunk(named.withColumn("text", T.sanitize(F.col("text"))))
    # As arrays of one: a filter on rows would sanitise a chunk again for every rule.
    cleaned = F.filter(
        F.array(F.struct(T.sanitize(F.col("text")).alias("text"))),
        lambda c: T.long_enough(c.text, min_chars) & ~T.looks_corrupted(c.text),
    )
    kept = chunks.select("source", F.inline(cleaned))
    return embed_column(kept, make_embedder, vec="embedding").select(
        H.chunk_key(F.col("source"), F.col("text")).alias("id"), "source", "text", "embedding", "embed_error"
    )


def export_chunks(
    files: DataFrame, path: str, make_embedder: MakeEmbedder | None = None, max_failed: float = 0.1, **options
) -> dict[str, int]:
    """Write chunk records as JSON lines; counts and limit as in ``build_index``."""
    records, seen = _counts(chunk_records(files, make_embedder, **options), "embedding")
    write_json_chunks(records.where(F.col("embedding").isNotNull()), path)
    return _checked(seen, max_failed)


def csv_index_rows(
    docs: DataFrame, make_embedder: MakeEmbedder | None = None, max_chars: int = 800, overlap: int = 160, batch: int = 8
) -> DataFrame:
    """Rows of the CSV vector index of ``doc`` and ``text`` columns; ``vec`` is null where the model failed."""
    embedded = embed_column(chunk(docs.select("doc", "text"), "text", max_chars, overlap), make_embedder, batch=batch)
    return embedded.select(
        "doc", F.col("chunk_id").cast("int").alias("chunk_idx"), F.length("text").alias("chars"), "vec"
    )


def export_csv_index(
    docs: DataFrame, path: str, make_embedder: MakeEmbedder | None = None, max_failed: float = 0.1, **options
) -> dict[str, int]:
    """Write the CSV vector index; counts and limit as in ``build_index``."""
    rows, seen = _counts(csv_index_rows(docs, make_embedder, **options), "vec")
    write_csv_index(rows.where(F.col("vec").isNotNull()), path)
    return _checked(seen, max_failed)


def postings(chunks: DataFrame) -> DataFrame:
    """How often each term occurs in each chunk.

    A chunk is one row, so its terms are counted where it lies, without a shuffle.
    """
    counts = T.term_counts(T.analyzed_tokens(F.col("text")))
    return chunks.select("doc_id", "chunk_id", F.inline(counts)).select("token", "doc_id", "chunk_id", "freq")


def record_shape(records: DataFrame) -> DataFrame:
    """How many index records break which rule of their shape."""
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("doc_id").isNull() | F.col("chunk_id").isNull() | F.col("text").isNull()).alias("missing"),
        F.count_if(F.coalesce(F.size("vec"), F.lit(0)) <= 0).alias("no_vector"),
        F.count_if(F.col("text").rlike(T.CONTROL)).alias("control_chars"),
    )


def record_shape_of_json(lines: DataFrame) -> DataFrame:
    """The same check over JSON lines in column ``value``."""
    shape = "doc_id string, chunk_id long, text string, vec array<float>"
    return record_shape(lines.select(F.from_json("value", shape).alias("r")).select("r.*"))


def index_counters(index: DataFrame) -> DataFrame:
    """Chunks prepared and embedded, and documents they come from."""
    return index.agg(
        F.count("*").alias("prepared"),
        F.count("vec").alias("embedded"),
        F.count_if(F.col("chunk_id") == 0).alias("documents"),
    )
