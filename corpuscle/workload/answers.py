"""Registered queries over the index: build, retrieve, guard, prompt, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.functions import vectors as V
from corpuscle.plans import answer as answer_plan
from corpuscle.plans import index as index_plan
from corpuscle.session import fresh_path
from corpuscle.sources import records, sinks
from corpuscle.sources.files import lines
from corpuscle.workload import sql as S
from corpuscle.workload import tables as D
from corpuscle.workload.registry import SQL, query
from corpuscle.workload.texts import failing_embedder

INDEX_SQL = f"""
    {S.RAW},
    source_docs AS (SELECT sha256(uri) AS doc_id, text FROM raw),
    {S.chunks('source_docs', 'doc_id', 800, 160)}
"""


@query(f"""
    WITH {INDEX_SQL}, {S.hash_weights('w', 'chunks', 'doc_id, chunk_id')}
    {S.dense('chunks', 'w', 'doc_id, chunk_id', f"{S.shard('s.doc_id', D.SHARDS)} AS shard, s.doc_id, s.chunk_id, s.text")}
""")
def rag_index(spark: SparkSession, folder: str) -> DataFrame:
    docs, path = fresh_path(spark, "docs"), fresh_path(spark, "index")
    D.index_source(spark, folder).write.parquet(docs)
    index_plan.build_index(spark, docs, path, D.SHARDS)
    vec = F.array_join(F.col("vec").cast("array<int>").cast("array<string>"), " ")
    return records.sharded_index(spark, path).select("shard", "doc_id", "chunk_id", "text", vec.alias("vec"))


@query(f"""
    WITH {INDEX_SQL}
    SELECT count(*) AS prepared, count(*) AS embedded, count(DISTINCT doc_id) AS documents FROM chunks
""")
def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    return index_plan.index_counters(index_plan.index_rows(D.index_source(spark, folder), D.SHARDS))


@query(f"""
    WITH {INDEX_SQL}
    SELECT count(*) AS records, 0::BIGINT AS missing, 0::BIGINT AS no_vector,
           count_if(regexp_matches(text, '[\\x00-\\x08\\x0b-\\x1f\\x7f]'))::BIGINT AS control_chars
    FROM chunks
""")
def record_shape(spark: SparkSession, folder: str) -> DataFrame:
    """The index as JSON records, parsed and checked."""
    rows = index_plan.index_rows(D.index_source(spark, folder), D.SHARDS)
    records_json = rows.select(F.to_json(F.struct("doc_id", "chunk_id", "text", "vec")).alias("value"))
    return index_plan.record_shape_of_json(records_json)


def _hits(spark: SparkSession, folder: str, metric: str = "cosine") -> DataFrame:
    index = index_plan.index_rows(D.index_source(spark, folder), D.SHARDS)
    # The index is worked out on the way, so no first rows of it are read to set floors.
    return answer_plan.retrieve(D.questions(spark, folder), index, metric=metric, floor_rows=0)


def _guarded(spark: SparkSession, folder: str, **limits) -> DataFrame:
    return answer_plan.guard(D.questions(spark, folder), _hits(spark, folder), **limits)


HITS_SQL = f"""
    SELECT question_id, rank, doc_id || '#' || chunk_id AS label, {S.fixed('score')} AS score,
           substring(text, 1, 200) AS preview
    FROM hits
"""


def _shown(hits: DataFrame) -> DataFrame:
    return hits.select(
        "question_id", "rank", "label", V.fixed_point(F.col("score")).alias("score"),
        T.preview(F.col("text"), 200, collapsed=False).alias("preview"),
    )


@query(f"WITH {S.RETRIEVED} {HITS_SQL}")
def rag_retrieve(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_hits(spark, folder))


@query(f"WITH {S.RETRIEVED_BY_DISTANCE} {HITS_SQL}")
def rag_retrieve_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_hits(spark, folder, "euclidean"))


@query(f"""
    WITH {S.GUARDED}
    SELECT question_id, n_hits, {S.fixed('top_score')} AS top_score, overlap, {S.ANSWERED} AS answered FROM guarded
""")
def rag_guard(spark: SparkSession, folder: str) -> DataFrame:
    return _guarded(spark, folder).select(
        "question_id", "n_hits", V.fixed_point(F.col("top_score")).alias("top_score"), "overlap", "answered"
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"""
    WITH {S.GUARDED}
    SELECT question_id, concat({_sql_text(T.PROMPT_HEAD)}, n_hits, {_sql_text(T.PROMPT_RULES)},
               array_to_string(list_transform(range(1, n_hits + 1),
                   lambda i: concat('[', i, '] ', {S.edge_trimmed('contexts[i]')})), chr(10) || '---' || chr(10)),
               {_sql_text(T.PROMPT_QUESTION)}, question, {_sql_text(T.PROMPT_TAIL)}) AS prompt
    FROM guarded WHERE {S.ANSWERED}
""")
def rag_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return answer_plan.prompts(_guarded(spark, folder)).drop("labels")


@query(f"""
    WITH {S.GUARDED}
    SELECT question_id, unnest(range(1, len(labels) + 1))::INTEGER AS n, unnest(labels) AS label
    FROM guarded WHERE {S.ANSWERED}
""")
def rag_sources(spark: SparkSession, folder: str) -> DataFrame:
    return answer_plan.source_list(_guarded(spark, folder))


@query(f"""
    WITH {S.GUARDED}
    SELECT question_id, {_sql_text(T.REFUSAL)} AS answer FROM guarded
    WHERE n_hits = 0 OR top_score < 0.6 OR overlap < 2
""")
def rag_refusals(spark: SparkSession, folder: str) -> DataFrame:
    """The refused questions under stricter limits."""
    return answer_plan.refusals(_guarded(spark, folder, min_top_score=0.6, min_keyword_overlap=2))


@query(f"""
    WITH {INDEX_SQL}, located AS (SELECT {S.shard('doc_id', D.SHARDS)} AS shard, text FROM chunks)
    SELECT shard, count(*) AS chunks, sum(length(text))::BIGINT AS chars FROM located GROUP BY shard
""")
def index_job_output(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks per shard as the text output of a batch job, read back."""
    rows = index_plan.index_rows(D.index_source(spark, folder), D.SHARDS)
    report = rows.groupBy("shard").agg(F.count("vec").alias("chunks"), F.sum(F.length("text")).alias("chars"))
    path = fresh_path(spark, "job-output")
    sinks.write_job_output(report, path)
    part = F.split("value", "\t")
    return lines(spark, path).select(
        part[0].cast("int").alias("shard"), part[1].cast("long").alias("chunks"), part[2].cast("long").alias("chars")
    )


def _built(spark: SparkSession, folder: str, **options) -> tuple[str, dict[str, int]]:
    docs, path = fresh_path(spark, "docs"), fresh_path(spark, "index")
    D.index_source(spark, folder).write.parquet(docs)
    return path, index_plan.build_index(spark, docs, path, D.SHARDS, **options)


@query(SQL["rag_index"])
def rag_index_again(spark: SparkSession, folder: str) -> DataFrame:
    """The index of half the documents and then of all: vectors of the first run are taken over, its build goes."""
    docs, path = fresh_path(spark, "docs"), fresh_path(spark, "index")
    source = D.index_source(spark, folder)
    half = F.pmod(F.xxhash64("docId"), F.lit(2)) == 0
    source.where(half).write.parquet(docs)
    index_plan.build_index(spark, docs, path, D.SHARDS, reuse=True)
    source.where(~half).write.mode("append").parquet(docs)
    index_plan.build_index(spark, docs, path, D.SHARDS, reuse=True, earlier=0)
    vec = F.array_join(F.col("vec").cast("array<int>").cast("array<string>"), " ")
    return records.sharded_index(spark, path).select("shard", "doc_id", "chunk_id", "text", vec.alias("vec"))


@query(SQL["rag_retrieve"])
def rag_retrieve_built(spark: SparkSession, folder: str) -> DataFrame:
    """The index is built once, with cells; questions read the cells they need to be exact."""
    path, _ = _built(spark, folder, metric="cosine", cells=32)
    return _shown(answer_plan.retrieve_from(D.questions(spark, folder), path))


@query(f"""
    WITH {INDEX_SQL}
    SELECT count(*) AS prepared, count_if(length(text) % 7 <> 0)::BIGINT AS embedded,
           count_if(length(text) % 7 = 0)::BIGINT AS failed,
           count(DISTINCT doc_id) FILTER (length(text) % 7 <> 0) AS documents
    FROM chunks
""")
def index_failures(spark: SparkSession, folder: str) -> DataFrame:
    """What the job counts, and documents in the index, when the model fails on known texts."""
    path, counts = _built(spark, folder, make_embedder=failing_embedder, max_failed=0.9, retries=0)
    return records.sharded_index(spark, path).agg(F.count_distinct("doc_id").alias("documents")).select(
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()], "documents")


@query("""
    SELECT coalesce(CASE WHEN doc_id % 5 > 0 THEN doc_id || '.txt' END, 'unknown.pdf') AS doc_id,
           coalesce(CASE WHEN doc_id % 3 > 0 THEN doc_id::VARCHAR END, '?') AS chunk_id,
           coalesce(CASE WHEN doc_id % 3 > 0 THEN doc_id END, -1) AS chunk_order, length(text) AS chars
    FROM documents WHERE doc_id % 7 > 0 AND text <> ''
""")
def index_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows without id, chunk number or text, as retrieval takes them."""
    number = F.col("doc_id")
    rows = D.documents(spark, folder, "doc_id", "text").select(
        F.lit(0).alias("shard"), F.when(number % 5 > 0, F.concat(number.cast("string"), F.lit(".txt"))).alias("doc_id"),
        F.when(number % 3 > 0, number).alias("chunk_id"), F.when(number % 7 > 0, F.col("text")).otherwise("").alias("text"),
        F.array(F.lit(1.0)).alias("vec"),
    )
    return index_plan.answerable(rows).select("doc_id", "chunk_id", "chunk_order", F.length("text").cast("long").alias("chars"))
