"""Readers of chunk, vector and vocabulary files that tolerate broken records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.functions.binding import bind
from corpuscle.sources.files import lines
from corpuscle.sources.sinks import BUILDS

# Ids and texts are read as variants first: a number in their place is a broken record.
CHUNK_RECORD = "id variant, source string, text variant, embedding array<double>"


def _usable(record: Column) -> Column:
    def is_string(field: Column) -> Column:
        return F.coalesce(F.schema_of_variant(field) == "STRING", F.lit(False))

    whole = F.coalesce(F.forall(record["embedding"], lambda x: x.isNotNull()), F.lit(False))
    return is_string(record["id"]) & is_string(record["text"]) & whole


def json_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records; lines that are blank, malformed, lack a required field or have a gap in the vector are left out."""
    # Filtered as arrays of one: a filter on rows would parse a line again for every field it looks at.
    record = F.filter(F.array(F.from_json("value", CHUNK_RECORD)), _usable)
    return spark.read.text(path).select(F.inline(record)).select(
        F.try_variant_get("id", "$", "string").alias("id"), "source", F.try_variant_get("text", "$", "string").alias("text"), "embedding",
    )


def json_chunk_counts(spark: SparkSession, path: str) -> DataFrame:
    """How many lines were parsed and how many skipped, blank lines included."""
    usable = bind(F.from_json("value", CHUNK_RECORD), _usable).alias("usable")
    return spark.read.text(path).select(usable).agg(
        F.count_if("usable").alias("parsed"), F.count_if(~F.col("usable")).alias("skipped")
    )


def csv_index(spark: SparkSession, path: str) -> DataFrame:
    """CSV vector index: doc, chunk_idx (-1 if no number), chars (0 if none), vec.

    Rows of fewer than four fields are left out; what follows a fourth comma belongs
    to the vector, of which the parts that are no numbers are left out.
    """
    rows = (
        spark.read.schema("doc string, chunk_idx string, chars string, vec string, _bad string")
        .option("header", True)
        .option("columnNameOfCorruptRecord", "_bad")
        .option("escape", '"')
        .csv(path)
    )
    # A row is marked when its number of fields is not four.  Beyond four the vector goes to the line's end.
    more = F.regexp_extract(F.col("_bad"), r'^(?:"(?:[^"]|"")*"|[^",]*),[^,]*,[^,]*,(.*)$', 1)
    vec = F.when(F.col("_bad").isNull(), F.col("vec")).otherwise(F.regexp_replace(more, '^"|"$', ""))
    return rows.where(F.col("vec").isNotNull()).select(
        T.unescape_lines(F.col("doc")).alias("doc"),
        F.coalesce(F.col("chunk_idx").try_cast("int"), F.lit(-1)).alias("chunk_idx"),
        F.coalesce(F.col("chars").try_cast("int"), F.lit(0)).alias("chars"),
        T.unpack_vector(vec).alias("vec"),
    )


class BadEmbeddingTable(ValueError):
    """A token-embedding table that cannot be used; ``code`` tells why."""

    # The exit codes of the checks.
    MISSING, EMPTY, NO_TOKEN, NO_DIMENSION, NO_ROWS = 2, 3, 4, 5, 6

    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def wide_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``token, d0, ...`` files as token and vector.

    The header tells the dimension.  Rows with another number of fields or with
    a field that is no number are left out; of a repeated token the last line
    counts.
    """
    try:
        names = spark.read.option("header", True).csv(path).columns  # reads one line
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise BadEmbeddingTable(BadEmbeddingTable.MISSING, f"no table at {path}") from error
        raise
    if not names:
        raise BadEmbeddingTable(BadEmbeddingTable.EMPTY, f"empty table at {path}")
    if names[0] != "token":
        raise BadEmbeddingTable(BadEmbeddingTable.NO_TOKEN, "the header must start with 'token'")
    dim = len(names) - 1
    if dim < 1:
        raise BadEmbeddingTable(BadEmbeddingTable.NO_DIMENSION, "the header names no dimension")
    # The header of every file drops out with the rows whose fields are no numbers.
    listed = ", ".join(["token string", *(f"d{i} string" for i in range(dim)), "_bad string"])
    parsed = F.from_csv("value", listed, {"columnNameOfCorruptRecord": "_bad", "escape": '"'}).alias("r")
    fields = lines(spark, path).select(parsed, "line_at").where("r._bad IS NULL")
    vec = F.array(*[F.col(f"r.d{i}").try_cast("float") for i in range(dim)])
    rows = fields.select(T.unescape_lines(F.col("r.token")).alias("token"), vec.alias("vec"), "line_at")
    whole = rows.where(F.forall("vec", lambda value: value.isNotNull()))
    return whole.groupBy("token").agg(F.max_by("vec", "line_at").alias("vec"))


def check_embeddings(embeddings: DataFrame, vec: str = "vec") -> DataFrame:
    """Return the table if it has rows and all its vectors one dimension; raise if not."""
    size = F.size(vec)
    found = embeddings.agg(F.count("*").alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    if not found.n:
        raise BadEmbeddingTable(BadEmbeddingTable.NO_ROWS, "no usable rows")
    if found.low != found.high or found.high < 1:
        raise BadEmbeddingTable(BadEmbeddingTable.NO_DIMENSION, f"dimensions {found.low} to {found.high}")
    return embeddings


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, token_id long, freq long").option("header", True).csv(path)


def top_vocabulary(spark: SparkSession, path: str, top_n: int) -> DataFrame:
    """The first ``top_n`` tokens by id."""
    return vocabulary(spark, path).orderBy("token_id").limit(top_n)


def docs_table(spark: SparkSession, path: str) -> DataFrame:
    """The columns of the docs table the index is built from."""
    return spark.read.parquet(path).select("docId", "uri", "text")


def current_build(spark: SparkSession, path: str) -> str:
    """The folder of the last finished build of the index at ``path``."""
    try:
        build = spark.read.parquet(f"{path}/{BUILDS}").orderBy(F.desc("at"), "build").first()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no index at {path}") from error
        raise
    if build is None:
        raise FileNotFoundError(f"no index at {path}")
    return f"{path}/{build.build}"


def sharded_index(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """The index at ``path``; only the directories of ``shards`` are read if given."""
    try:
        index = spark.read.parquet(f"{current_build(spark, path)}/rows")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no shards under {path}") from error
        raise
    if "shard" not in index.columns:
        raise FileNotFoundError(f"no shards under {path}")
    return index if shards is None else index.where(F.col("shard").isin(shards))


def shards_of(spark: SparkSession, path: str) -> list[int]:
    """The shards found under ``path``; no data column is read for it."""
    return sorted(row.shard for row in sharded_index(spark, path).select("shard").distinct().collect())
