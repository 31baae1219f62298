"""Registered queries over documents: cleaning, chunks, vocabulary, ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.functions import text as T
from corpuscle.functions import vectors as V
from corpuscle.operators import textsearch
from corpuscle.operators.chunking import chunk, chunk_by_paragraph
from corpuscle.operators.embed import embed_column, hashing_embedder
from corpuscle.operators.upsert import upsert
from corpuscle.plans import index as index_plan
from corpuscle.plans import ingest as ingest_plan
from corpuscle.plans import stats
from corpuscle.session import fresh_path
from corpuscle.sources import files as files_source
from corpuscle.sources import records, sinks
from corpuscle.streaming.ingest import file_stream, ingest_stream
from corpuscle.workload import sql as S
from corpuscle.workload import tables as D
from corpuscle.workload.registry import SQL, query


@query(f"SELECT doc_id, {S.sanitized('text')} AS text FROM documents WHERE length({S.sanitized('text')}) > 0")
def sanitize_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.documents(spark, folder, "doc_id", "text").where(T.sanitizes_to_text(F.col("text")))
    return docs.select("doc_id", T.sanitize(F.col("text")).alias("text"))


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 1000, 200, S.sanitized('text'))},
    judged AS (
        SELECT doc_id, length(text) < 120 AS short,
               text = '' OR length(regexp_replace(text, '[\\x00-\\x{{FF}}]', '', 'g')) / length(text) > 0.1 AS bad,
               length(regexp_replace(text, '[\\x00-\\x{{FF}}]', '', 'g')) AS odd
        FROM chunks)
    SELECT doc_id, count(*) AS chunks, count_if(short)::BIGINT AS short, count_if(bad)::BIGINT AS corrupted,
           count_if(NOT short AND NOT bad)::BIGINT AS kept, sum(odd)::BIGINT AS odd_chars
    FROM judged GROUP BY doc_id
""")
def corrupt_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.documents(spark, folder, "doc_id", "text").withColumn("text", T.sanitize(F.col("text")))
    long, bad = T.long_enough(F.col("text")), T.looks_corrupted(F.col("text"))
    judged = chunk(docs).select(
        "doc_id", long.alias("long"), bad.alias("bad"),
        T.odd_chars(F.col("text")).alias("odd"),
    )
    return judged.groupBy("doc_id").agg(
        F.count("*").alias("chunks"), F.count_if(~F.col("long")).alias("short"),
        F.count_if("bad").alias("corrupted"), F.count_if(F.col("long") & ~F.col("bad")).alias("kept"),
        F.sum("odd").alias("odd_chars"),
    )


DOCS_SQL = f"""
    SELECT uri, t AS text, 'en' AS language,
           CASE WHEN t <> '' THEN t ELSE regexp_extract(uri, '[^/]+$') END AS title,
           sha256(uri) AS "docId", sha256(t) AS "contentHash"
    FROM (SELECT uri, {S.sanitized('text')} AS t FROM raw)
"""


@query(f"WITH {S.RAW} {DOCS_SQL}")
def docs_table(spark: SparkSession, folder: str) -> DataFrame:
    return ingest_plan.docs_from_text(D.raw_documents(spark, folder))


@query(f"""
    WITH {S.RAW},
    firsts AS (
        SELECT doc_id, uri, text, {S.edge_trimmed("string_split_regex(text, '[\\n\\f]')[1]")} AS first_line FROM raw)
    SELECT doc_id, CASE WHEN first_line <> '' THEN first_line ELSE regexp_extract(uri, '[^/]+$') END AS title,
           substring(regexp_replace(text, '{S.SPACES}', ' ', 'g'), 1, 160) AS preview,
           substring(text, 1, 500) AS head, uri LIKE '%.pdf' AS pdf
    FROM firsts
""")
def title_and_preview(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.documents(spark, folder, "doc_id", "source", "text").withColumn("uri", D.uri())
    return docs.select(
        "doc_id", T.title(F.col("text"), F.col("uri")).alias("title"),
        T.preview(F.col("text")).alias("preview"),
        T.preview(F.col("text"), 500, collapsed=False).alias("head"), T.is_pdf(F.col("uri")).alias("pdf"),
    )


@query(f"""
    WITH {S.RAW},
    edited AS (
        SELECT uri, text || CASE WHEN l.toxic = 1 THEN ' v2' ELSE '' END AS text
        FROM raw LEFT JOIN labels l USING (doc_id)
        UNION ALL SELECT url, html FROM pages),
    before AS (SELECT sha256(uri) AS d, sha256({S.sanitized('text')}) AS h, uri FROM raw),
    after AS (SELECT sha256(uri) AS d, sha256({S.sanitized('text')}) AS h, uri FROM edited)
    SELECT uri, d AS "docId", h AS "contentHash" FROM before
    UNION ALL
    SELECT uri, d, h FROM after a WHERE NOT EXISTS (SELECT 1 FROM before b WHERE b.d = a.d AND b.h = a.h)
""")
def docs_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots: the documents, then the documents with edited toxic ones and the pages."""
    docs = D.documents(spark, folder, "doc_id", "source", "text")
    toxic = D.table(spark, folder, "labels").where("toxic = 1").select("doc_id", F.lit(" v2").alias("edit"))
    edited = docs.join(toxic, "doc_id", "left").select(
        D.uri().alias("uri"), F.concat("text", F.coalesce("edit", F.lit(""))).alias("text")
    )
    pages = D.table(spark, folder, "pages").select(F.col("url").alias("uri"), F.col("html").alias("text"))
    path = fresh_path(spark, "docs")
    upsert(ingest_plan.docs_from_text(docs.select(D.uri().alias("uri"), "text")), path)
    upsert(ingest_plan.docs_from_text(edited.unionByName(pages)), path)
    return spark.read.parquet(path).select("uri", "docId", "contentHash")


@query(f"WITH {S.chunks('documents', 'doc_id', 1000, 200)} SELECT doc_id, chunk_id, text FROM chunks")
def chunks_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return chunk(D.documents(spark, folder, "doc_id", "text"))


PARAGRAPH_SQL = f"""
    paragraphs AS (
        SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
               lambda p: {S.edge_trimmed('p')}), lambda p: length(p) > 0) AS ps
        FROM documents),
    packing AS (
        SELECT doc_id, ps, 0 AS i, ''::VARCHAR AS open, []::VARCHAR[] AS closed FROM paragraphs
        UNION ALL
        SELECT doc_id, ps, i + 1,
               CASE WHEN length(open) + length(ps[i + 1]) + 1 <= 1200
                    THEN CASE WHEN open = '' THEN ps[i + 1] ELSE open || chr(10) || ps[i + 1] END
                    WHEN length(ps[i + 1]) > 1200 THEN '' ELSE ps[i + 1] END,
               CASE WHEN length(open) + length(ps[i + 1]) + 1 <= 1200 THEN []::VARCHAR[]
                    WHEN length(ps[i + 1]) > 1200 THEN list_concat([open],
                         list_transform(range(0, length(ps[i + 1]), 1200),
                                        lambda pos: substring(ps[i + 1], pos + 1, 1200)))
                    ELSE [open] END
        FROM packing WHERE i < len(ps)),
    emitted AS (
        SELECT doc_id, i, unnest(range(1, len(closed) + 1)) AS j, unnest(closed) AS piece FROM packing
        UNION ALL SELECT doc_id, i + 1, 1, open FROM packing WHERE i = len(ps)),
    pieces AS (SELECT doc_id, i, j, {S.sanitized('piece')} AS text FROM emitted)
"""


@query(f"""
    WITH RECURSIVE {PARAGRAPH_SQL}
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS chunk_id, text
    FROM pieces WHERE length(text) >= 120
""")
def chunks_paragraph(spark: SparkSession, folder: str) -> DataFrame:
    """The documents have no blank lines, so single newlines separate their paragraphs."""
    return chunk_by_paragraph(D.documents(spark, folder, "doc_id", "text"), separator="\n")


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 1000, 200)}
    SELECT doc_id, chunk_id, concat(doc_id, '.txt#', substr(sha256(text), 1, 12)) AS id FROM chunks
""")
def chunk_ids(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    chunks = chunk(D.documents(spark, folder, "doc_id", "text"))
    return chunks.select("doc_id", "chunk_id", H.chunk_key(name, F.col("text")).alias("id"))


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 1000, 200)}
    SELECT doc_id, chunk_id, concat(doc_id, '#', chunk_id) AS label,
           substring(regexp_replace(text, '{S.SPACES}', ' ', 'g'), 1, 160) AS preview
    FROM chunks WHERE chunk_id < 4
""")
def first_chunks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk(D.documents(spark, folder, "doc_id", "text")).where("chunk_id < 4")
    return chunks.select(
        "doc_id", "chunk_id", T.hit_label(F.col("doc_id").cast("string"), F.col("chunk_id")).alias("label"),
        T.preview(F.col("text")).alias("preview"),
    )


@query(f"""
    WITH {S.RAW}, placed AS (SELECT {S.shard('sha256(uri)', D.SHARDS)} AS shard FROM raw)
    SELECT shard, count(*) AS docs FROM placed GROUP BY shard
""")
def shard_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.documents(spark, folder, "doc_id", "source").select(H.sha256(D.uri()).alias("docId"))
    return docs.groupBy(H.shard_of(F.col("docId"), D.SHARDS).alias("shard")).agg(F.count("*").alias("docs"))


VOCAB_SQL = f"""
    {S.chunks('documents', 'doc_id', 1200, 240)},
    tokens AS (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z][a-zA-Z0-9_\\-]+')) AS token FROM chunks),
    counted AS (SELECT token, count(*) AS freq FROM tokens WHERE length(token) BETWEEN 2 AND 40 GROUP BY token),
    vocab AS (SELECT token, row_number() OVER (ORDER BY freq DESC, token) - 1 AS token_id, freq FROM counted)
"""


@query(f"WITH {VOCAB_SQL} SELECT * FROM vocab")
def vocab(spark: SparkSession, folder: str) -> DataFrame:
    return stats.vocabulary(D.documents(spark, folder, "text"))


@query(f"WITH {VOCAB_SQL} SELECT * FROM vocab WHERE token_id < 3000")
def vocab_topn(spark: SparkSession, folder: str) -> DataFrame:
    return stats.frequent_tokens(D.documents(spark, folder, "text"), 3000)


def _vocabulary_file(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "vocab-csv")
    stats.export_vocabulary(D.documents(spark, folder, "text"), path)
    return path


@query(f"WITH {VOCAB_SQL} SELECT token, token_id, freq FROM vocab")
def vocab_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return records.vocabulary(spark, _vocabulary_file(spark, folder))


@query(f"WITH {VOCAB_SQL} SELECT token, token_id, freq FROM vocab WHERE token_id < 5000")
def vocab_csv_top(spark: SparkSession, folder: str) -> DataFrame:
    """The first tokens of the file, as the graph job reads them."""
    return records.top_vocabulary(spark, _vocabulary_file(spark, folder), 5000)


@query(f"WITH {S.RAW} SELECT uri FROM raw")
def manifest_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's path in a manifest with byte-order marks, carriage returns and blank lines."""
    path = fresh_path(spark, "manifest")
    line = F.concat(F.lit(files_source.BYTE_ORDER_MARK + " "), D.uri(), F.lit(" \r\n \n"))
    D.documents(spark, folder, "doc_id", "source").select(line.alias("value")).write.text(path)
    return files_source.manifest(spark, path)


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 800, 160)},
    words AS (SELECT doc_id, chunk_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS token
              FROM chunks)
    SELECT token, doc_id, chunk_id, count(*) AS freq FROM words GROUP BY ALL
""")
def postings(spark: SparkSession, folder: str) -> DataFrame:
    return index_plan.postings(chunk(D.documents(spark, folder, "doc_id", "text"), "text", 800, 160))


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 800, 160)},
    words AS (SELECT doc_id, chunk_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS token
              FROM chunks),
    tf AS (SELECT token, doc_id, chunk_id, count(*) AS f FROM words GROUP BY ALL),
    sizes AS (SELECT doc_id, chunk_id, count(*) AS size FROM words GROUP BY ALL),
    whole AS (SELECT count(*) AS n, avg(size) AS mean FROM sizes),
    df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    asked AS (SELECT item_id, token, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS token FROM benchmark) GROUP BY ALL),
    scored AS (
        SELECT item_id, doc_id, chunk_id,
               {S.grid(f"sum(times * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * f / (f + {textsearch.K1}::DOUBLE * (1 - {textsearch.B}::DOUBLE + {textsearch.B}::DOUBLE * size / mean)))")} AS g
        FROM asked JOIN tf USING (token) JOIN df USING (token) JOIN sizes USING (doc_id, chunk_id), whole
        GROUP BY item_id, doc_id, chunk_id),
    hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY g DESC, doc_id, chunk_id)::INTEGER AS rank FROM scored QUALIFY rank <= 8)
    SELECT item_id AS question_id, doc_id, chunk_id, {S.fixed('g / 1e9::DOUBLE')} AS score, rank FROM hits
""")
def text_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The eight chunks that rank highest by their words for every question, from blocks of postings."""
    path = textsearch.text_index(chunk(D.documents(spark, folder, "doc_id", "text"), "text", 800, 160), ["doc_id", "chunk_id"])
    hits = textsearch.ranked_text(D.questions(spark, folder), path)
    return hits.select("question_id", "doc_id", "chunk_id", V.fixed_point(F.col("score")).alias("score"), "rank")


@query(f"""
    SELECT (page_id % 8)::VARCHAR AS part, {S.sanitized("coalesce(html, '')")} AS text,
           sha256({S.sanitized("coalesce(html, '')")}) AS "contentHash" FROM pages
""")
def decode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as files, read back as bytes through the path the ingest job takes."""
    files = files_source.document_files(spark, D.write_files(spark, folder))
    docs = ingest_plan.docs_from_files(files)
    return docs.select(F.regexp_extract("uri", "part=([^/]+)/", 1).alias("part"), "text", "contentHash")


@query("""
    SELECT (page_id % 8)::VARCHAR AS part, count(*) AS files, sum(strlen(coalesce(html, '')) + 1)::BIGINT AS bytes
    FROM pages GROUP BY 1
""")
def bytes_by_uri(spark: SparkSession, folder: str) -> DataFrame:
    """The same files through a list of URIs with their scheme; the writer ends each with a line feed."""
    path = D.write_files(spark, folder)
    scheme = "" if ":" in path.split("/")[0] else "file:"
    there = files_source.binary_files(spark, [f"{scheme}{path}/part={i}" for i in range(8)])
    return there.groupBy(F.regexp_extract("path", "part=([^/]+)/", 1).alias("part")).agg(
        F.count("*").alias("files"), F.sum(F.octet_length("content")).alias("bytes"))


@query(f"""
    SELECT sha256({S.sanitized("coalesce(html, '')")}) AS "contentHash", count(*) AS files FROM pages GROUP BY 1
""")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The same files taken in as a stream, twice: the second run must add nothing."""
    raw, path = D.write_files(spark, folder), fresh_path(spark, "stream-docs")
    for run in ("first", "second"):
        checkpoint = fresh_path(spark, f"stream-{run}")
        ingest_stream(file_stream(spark, raw), path, checkpoint).awaitTermination()
    return spark.read.parquet(path).groupBy("contentHash").agg(F.count("*").alias("files"))


@query(f"""
    WITH long AS (SELECT doc_id, repeat(text, 10) AS text FROM documents), {S.chunks('long', 'doc_id', 800, 160)}
    SELECT doc_id, count(*) AS chunks, sum(length(text))::BIGINT AS chars FROM chunks GROUP BY doc_id
""")
def chunks_long(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of documents ten times as long; a document's windows are counted where they are cut."""
    docs = D.documents(spark, folder, "doc_id", "text").withColumn("text", F.repeat("text", F.lit(10)))
    return chunk(docs, "text", 800, 160).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"))


# Fixed value: the refusal sentence, with quotes doubled for SQL.
REFUSAL_SQL = "I don''t know based on the MSR corpus."


@query(f"""
    WITH answers AS (
        SELECT conv_id, turn, concat(text, chr(10), chr(10), ' ', chr(10), '{REFUSAL_SQL}', chr(10), '  ', chr(10),
               '[', turn, '] [', conv_id, '] [0', turn, ']', chr(10)) AS raw
        FROM conversations WHERE role = 'assistant'),
    cleaned AS (
        SELECT conv_id, turn, {S.edge_trimmed(
            "regexp_replace(regexp_replace(raw, "
            "'(?m)^[ \\t\\n\\x0b\\f\\r]*I don''t know based on the MSR corpus\\.?[ \\t\\n\\x0b\\f\\r]*$', '', 'g'), "
            "'(?m)^([ \\t\\n\\x0b\\f\\r]*\\n){2,}', chr(10), 'g')")} AS answer
        FROM answers)
    SELECT conv_id, turn, regexp_replace(answer, '\\[(0+|0*[4-9]|0*[1-9][0-9]+)\\]', '', 'g') AS answer FROM cleaned
""")
def answer_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    """Assistant turns with a refusal line and citations, in and out of range, added."""
    from corpuscle.plans.answer import clean_answers

    turn, conv = F.col("turn").cast("string"), F.col("conv_id").cast("string")
    raw = F.concat(
        F.col("text"), F.lit("\n\n \n" + T.REFUSAL + "\n  \n["), turn, F.lit("] ["), conv, F.lit("] [0"), turn, F.lit("]\n")
    )
    turns = D.table(spark, folder, "conversations").where("role = 'assistant'")
    answers = turns.select("conv_id", "turn", raw.alias("answer"), F.lit(3).alias("n_hits"))
    return clean_answers(answers).drop("n_hits")


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 1000, 200, S.sanitized('text'))},
    kept AS (SELECT doc_id, chunk_id, {S.sanitized('text')} AS text FROM chunks
             WHERE length({S.sanitized('text')}) >= 120),
    {S.hash_weights('w', 'kept', 'doc_id, chunk_id')}
    {S.dense('kept', 'w', 'doc_id, chunk_id',
             "concat(s.doc_id, '.txt#', substr(sha256(s.text), 1, 12)) AS id, concat(s.doc_id, '.txt') AS source, s.text")}
""")
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk records written as JSON lines among broken ones, then read back."""
    vec = F.array_join(F.col("embedding").cast("array<int>").cast("array<string>"), " ")
    read = records.json_chunks(spark, _json_lines(spark, folder))
    return read.select("id", "source", "text", vec.alias("vec"))


def _json_lines(spark: SparkSession, folder: str) -> str:
    """Every chunk record next to a blank, a broken, an incomplete and an ill-typed line."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    files = D.documents(spark, folder, "doc_id", "text").select(name.alias("name"), "text")
    rows = index_plan.chunk_records(files).where(F.col("embedding").isNotNull())
    whole = F.to_json(F.struct("id", "source", "text", "embedding"))
    partial = F.to_json(F.struct("id", "source", "text"))
    numbered = F.to_json(F.struct(F.lit(7).alias("id"), "source", "text", "embedding"))
    lines = F.array(whole, F.lit("  "), F.lit("{bad"), partial, numbered)
    path = fresh_path(spark, "chunks-jsonl")
    rows.select(F.explode(lines).alias("value")).write.text(path)
    return path


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 1000, 200, S.sanitized('text'))}
    SELECT count(*) AS parsed, 4 * count(*) AS skipped FROM chunks WHERE length({S.sanitized('text')}) >= 120
""")
def jsonl_counters(spark: SparkSession, folder: str) -> DataFrame:
    return records.json_chunk_counts(spark, _json_lines(spark, folder))


@query(f"""
    WITH {S.chunks('documents', 'doc_id', 800, 160)},
    {S.hash_weights('w', 'chunks', 'doc_id, chunk_id')}
    {S.dense('chunks', 'w', 'doc_id, chunk_id',
             "concat(s.doc_id, '.txt') AS doc, s.chunk_id::INTEGER AS chunk_idx, length(s.text)::INTEGER AS chars")}
""")
def csv_index_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = fresh_path(spark, "index-csv")
    index_plan.export_csv_index(D.documents(spark, folder, "doc_id", "text").select(doc.alias("doc"), "text"), path)
    vec = F.array_join(F.col("vec").cast("array<int>").cast("array<string>"), " ")
    return records.csv_index(spark, path).withColumn("vec", vec)


@query(f"""
    WITH {S.hash_weights('w', 'documents', 'doc_id')}
    {S.dense('documents', 'w', 'doc_id', 's.doc_id')}
""")
def hash_embed(spark: SparkSession, folder: str) -> DataFrame:
    embedded = embed_column(D.documents(spark, folder, "doc_id", "text"))
    vec = F.array_join(F.col("vec").cast("array<int>").cast("array<string>"), " ")
    return embedded.select("doc_id", vec.alias("vec"))




def failing_embedder():
    """The default model, out of order on every text whose length is a multiple of seven."""
    model = hashing_embedder()()

    def embed(texts: list[str]):
        if any(len(text) % 7 == 0 for text in texts):
            raise RuntimeError("out of order")
        return model(texts)

    return embed


@query("SELECT doc_id, length(text) % 7 = 0 AS failed FROM documents")
def embed_failures(spark: SparkSession, folder: str) -> DataFrame:
    """A failing group is embedded text by text; only the texts at fault have no vector, and a reason."""
    docs = D.documents(spark, folder, "doc_id", "text")
    rows = embed_column(docs, failing_embedder, retries=1, pause=0.0)
    reason = F.col("embed_error").eqNullSafe("RuntimeError: out of order")
    return rows.select("doc_id", (F.col("vec").isNull() & reason).alias("failed")).where(
        F.col("failed") | F.col("vec").isNotNull())


@query(SQL["jsonl_roundtrip"])
def json_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk records through the job that writes them."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = fresh_path(spark, "chunks-json")
    index_plan.export_chunks(D.documents(spark, folder, "doc_id", "text").select(name.alias("name"), "text"), path)
    vec = F.array_join(F.col("embedding").cast("array<int>").cast("array<string>"), " ")
    return records.json_chunks(spark, path).select("id", "source", "text", vec.alias("vec"))


ODD_NAME = "concat('a,\"b\"', chr(10), doc_id, chr(13), '\\n\\', lang, ',')"


@query(f"""
    SELECT {ODD_NAME} AS doc, 7 AS chunk_idx, length(text)::INTEGER AS chars, doc_id::DOUBLE AS first FROM documents
""")
def csv_odd_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names with commas, quotes, line ends and backslashes through the CSV index."""
    path = fresh_path(spark, "odd-csv")
    rows = D.documents(spark, folder, "doc_id", "lang", "text").select(
        _odd_name().alias("doc"), F.lit(7).alias("chunk_idx"), F.length("text").alias("chars"),
        F.array(F.col("doc_id").cast("float"), F.lit(0.5).cast("float")).alias("vec"),
    )
    sinks.write_csv_index(rows, path)
    return records.csv_index(spark, path).select("doc", "chunk_idx", "chars", F.col("vec")[0].cast("double").alias("first"))


def _odd_name():
    return F.concat(F.lit('a,"b"\n'), F.col("doc_id").cast("string"), F.lit("\r\\n\\"), "lang", F.lit(","))


@query(f"SELECT {ODD_NAME} AS token, 2 AS dim, doc_id::DOUBLE AS first FROM documents")
def wide_odd_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The same names as tokens of a wide embedding table."""
    path = fresh_path(spark, "odd-wide")
    rows = D.documents(spark, folder, "doc_id", "lang").select(
        _odd_name().alias("token"), F.array(F.col("doc_id").cast("float"), F.lit(0.5).cast("float")).alias("vec"))
    sinks.write_wide_embeddings(rows, path)
    return records.wide_embeddings(spark, path).select(
        "token", F.size("vec").alias("dim"), F.col("vec")[0].cast("double").alias("first"))
