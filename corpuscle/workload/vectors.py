"""Registered queries over vectors: arithmetic, search, graph, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.functions import vectors as V
from corpuscle.operators.cells import build_cells
from corpuscle.operators.descent import knn_descent
from corpuscle.operators.quantized import build_quantized, top_k_quantized
from corpuscle.operators.search import top_k, top_k_in_cells, top_k_single
from corpuscle.plans import stats
from corpuscle.session import fresh_path, stage
from corpuscle.sources import records, sinks
from corpuscle.workload import sql as S
from corpuscle.workload import tables as D
from corpuscle.workload.registry import SQL, query
from corpuscle.workload.texts import VOCAB_SQL


@query(f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * label) AS e FROM embeddings),
    unit AS (SELECT vec_id, e, CASE WHEN {S.norm('e')} = 0 THEN e
                 ELSE list_transform(e, lambda x: x / {S.norm('e')}) END AS u FROM v)
    SELECT vec_id, len(u)::INTEGER AS dim, {S.fixed(S.norm('e'))} AS norm_before, {S.fixed(S.norm('u'))} AS norm_after,
           {S.fixed('u[1]')} AS first, {S.fixed('u[len(u)]')} AS last
    FROM unit
""")
def l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors stretched by their label, so label 0 gives zero vectors."""
    rows = D.table(spark, folder, "embeddings")
    stretched = F.transform(V.as_double(F.col("embedding")), lambda x: x * F.col("label"))
    unit = rows.select("vec_id", stretched.alias("e")).withColumn("u", V.l2_normalize(F.col("e")))
    return unit.select(
        "vec_id", V.dimension(F.col("u")).alias("dim"),
        V.fixed_point(V.norm(F.col("e"))).alias("norm_before"), V.fixed_point(V.norm(F.col("u"))).alias("norm_after"),
        V.fixed_point(F.col("u")[0]).alias("first"), V.fixed_point(F.element_at("u", -1)).alias("last"),
    )


@query(f"""
    WITH p AS (
        SELECT a.vec_id, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y,
               a.embedding[1:32]::DOUBLE[] AS h, b.embedding[1:32]::DOUBLE[] AS hb
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
    q AS (SELECT *, list_transform(range(1, len(x) + 1), lambda i: x[i] + y[i]) AS plus,
                 list_transform(range(1, len(x) + 1), lambda i: x[i] - y[i]) AS minus FROM p)
    SELECT vec_id, {S.fixed(S.norm('plus'))} AS norm_sum, {S.fixed(S.norm('minus'))} AS norm_difference,
           {S.fixed('list_inner_product(x, y)')} AS dot, {S.fixed('list_inner_product(h, hb)')} AS dot_prefix,
           {S.fixed(S.cosine('x', 'y'))} AS cosine,
           {S.fixed(f"list_inner_product(h, hb) / ({S.norm('h')} * {S.norm('y')})")} AS cosine_prefix,
           0.0::DOUBLE AS cosine_strict,
           {S.fixed(f"1 / (1 + list_inner_product(minus, minus))")} AS euclidean
    FROM q
""")
def vector_arith(spark: SparkSession, folder: str) -> DataFrame:
    """Arithmetic on every vector and its successor, and on its first half and the successor."""
    rows = D.vectors(spark, folder)
    x = rows.select("vec_id", F.col("vec").alias("x"))
    y = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("y"))
    half, a, b = F.slice("x", 1, 32), F.col("x"), F.col("y")
    fixed = V.fixed_point
    return x.join(y, "vec_id").select(
        "vec_id",
        fixed(V.norm(V.add(a, b))).alias("norm_sum"), fixed(V.norm(V.subtract(a, b))).alias("norm_difference"),
        fixed(V.dot(a, b)).alias("dot"), fixed(V.dot(half, b)).alias("dot_prefix"),
        fixed(V.cosine(a, b)).alias("cosine"), fixed(V.cosine(half, b)).alias("cosine_prefix"),
        V.cosine_strict(half, b).alias("cosine_strict"), fixed(V.euclidean_score(a, b)).alias("euclidean"),
    )


def _search_sql(score: str, corpus: str = "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings", k: int = 10) -> str:
    return f"""
    WITH {S.CENTROIDS}, corpus AS ({corpus}),
    scored AS (SELECT label, vec_id, {S.grid(score)} AS g FROM centroids CROSS JOIN corpus),
    hits AS (SELECT label, vec_id, g / 1e9::DOUBLE AS score,
                    row_number() OVER (PARTITION BY label ORDER BY g DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT label, vec_id, {S.fixed('score')} AS score, rank FROM hits WHERE rank <= {k}
    """


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", V.fixed_point(F.col("score")))


@query(_search_sql(S.cosine("q", "v")))
def cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    asked = D.label_centroids(spark, folder)
    return _rounded(top_k(asked, D.vectors(spark, folder), 10, "label", ["vec_id"]))


@query(f"""
    WITH parts AS (SELECT unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
    mean AS (SELECT list(x ORDER BY pos) AS q FROM (SELECT pos, avg(x) AS x FROM parts GROUP BY pos))
    SELECT vec_id, {S.fixed(S.cosine('q', 'embedding::DOUBLE[]'))} AS score FROM embeddings CROSS JOIN mean
    ORDER BY {S.grid(S.cosine('q', 'embedding::DOUBLE[]'))} DESC, vec_id LIMIT 25
""")
def cosine_topk_single(spark: SparkSession, folder: str) -> DataFrame:
    """One question, the mean vector, in column expressions alone."""
    parts = D.table(spark, folder, "embeddings").select(F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("x")).orderBy("at").collect()  # one per dimension
    return _rounded(top_k_single(D.vectors(spark, folder), [row.x for row in means], 25, ["vec_id"]))


STRICT_CORPUS = """SELECT vec_id, (CASE WHEN label = 0 THEN embedding[1:32] ELSE embedding END)::DOUBLE[] AS v
                   FROM embeddings"""


@query(_search_sql(f"CASE WHEN len(v) <> 64 THEN 0 ELSE {S.cosine('q', 'list_resize(v, 64, 0.0)')} END", STRICT_CORPUS))
def cosine_topk_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of label 0 are cut to half their length and must score 0."""
    cut = F.when(F.col("label") == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    corpus = D.table(spark, folder, "embeddings").select("vec_id", cut.alias("vec"))
    asked = D.label_centroids(spark, folder)
    return _rounded(top_k(asked, corpus, 10, "label", ["vec_id"], metric="cosine_strict"))


@query(_search_sql("1 / (1 + list_inner_product(q, q) + list_inner_product(v, v) - 2 * list_inner_product(q, v))"))
def euclid_topk(spark: SparkSession, folder: str) -> DataFrame:
    asked = D.label_centroids(spark, folder)
    return _rounded(top_k(asked, D.vectors(spark, folder), 10, "label", ["vec_id"], metric="euclidean"))


@query(f"""
    WITH {S.CENTROIDS},
    corpus AS (SELECT vec_id, embedding::DOUBLE[] AS v, {S.shard('sha256(vec_id::VARCHAR)', D.SHARDS)} AS shard
               FROM embeddings),
    scored AS (SELECT label, shard, vec_id, {S.grid(S.cosine('q', 'v'))} AS g FROM centroids CROSS JOIN corpus),
    fetched AS (SELECT *, row_number() OVER (PARTITION BY label, shard ORDER BY g DESC, vec_id) AS r
                FROM scored QUALIFY r <= 8),
    merged AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY g DESC, vec_id)::INTEGER AS rank
               FROM fetched QUALIFY rank <= 5)
    SELECT label, shard, vec_id, {S.fixed('g / 1e9::DOUBLE')} AS score, rank FROM merged
""")
def sharded_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors written as a sharded index and searched shard by shard."""
    path = fresh_path(spark, "vector-index")
    shard = H.shard_of(H.sha256(F.col("vec_id").cast("string")), D.SHARDS)
    sinks.write_sharded_index(D.vectors(spark, folder).withColumn("shard", shard), path)
    index = records.sharded_index(spark, path)
    asked = D.label_centroids(spark, folder)
    return _rounded(top_k(asked, index, 5, "label", ["vec_id"], shard="shard", fetch=8))


KNN_SQL = f"""
    WITH pairs AS (
        SELECT a.vec_id AS token, b.vec_id AS neighbor,
               {S.grid(S.cosine('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]'))} AS g
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    near AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY g DESC, neighbor)::INTEGER AS rank
             FROM pairs QUALIFY rank <= 10)
    SELECT token, neighbor, {S.fixed('g / 1e9::DOUBLE')} AS cosine, rank FROM near
"""


def _edges(spark: SparkSession, folder: str, **search) -> DataFrame:
    tokens = D.vectors(spark, folder).withColumnRenamed("vec_id", "token")
    return stats.knn_graph(tokens, 10, **search).withColumn("cosine", V.fixed_point(F.col("cosine")))


@query(KNN_SQL)
def knn_graph(spark: SparkSession, folder: str) -> DataFrame:
    return _edges(spark, folder)


@query(KNN_SQL)
def knn_graph_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same graph through cells."""
    return _edges(spark, folder, form="cells", cells=16)


SPOILT_SQL = f"""
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 7 <> 0),
    pairs AS (SELECT a.vec_id AS token, b.vec_id AS neighbor, {S.grid(S.cosine('a.v', 'b.v'))} AS g
              FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    near AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY g DESC, neighbor)::INTEGER AS rank
             FROM pairs QUALIFY rank <= 10)
    SELECT token, neighbor, {S.fixed('g / 1e9::DOUBLE')} AS cosine, rank FROM near
"""


def _spoilt_edges(spark: SparkSession, folder: str, **search) -> DataFrame:
    """The graph when every seventh vector has no number, an infinity or a gap in it."""
    bad = F.element_at(F.array(F.lit("NaN"), F.lit("Infinity"), F.lit(None)).cast("array<float>"), (F.col("vec_id") % 3 + 1).cast("int"))
    spoilt = F.when(F.col("vec_id") % 7 == 0, F.concat(F.slice("vec", F.lit(2), F.size("vec")), F.array(bad))).otherwise(F.col("vec"))
    tokens = D.vectors(spark, folder).select(F.col("vec_id").alias("token"), spoilt.alias("vec"))
    return stats.knn_graph(tokens, 10, **search).withColumn("cosine", V.fixed_point(F.col("cosine")))


@query(SPOILT_SQL)
def knn_spoilt_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _spoilt_edges(spark, folder, group_queries=200)


@query(SPOILT_SQL)
def knn_spoilt_cells(spark: SparkSession, folder: str) -> DataFrame:
    return _spoilt_edges(spark, folder, form="cells", cells=16)


POINTS_SQL = """
    points AS (SELECT vec_id, md5(vec_id::VARCHAR) AS o,
                      list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_inner_product(embedding::DOUBLE[],
                                     embedding::DOUBLE[]))) AS p, embedding::DOUBLE[] AS v FROM embeddings),
    head AS (SELECT *, row_number() OVER (ORDER BY o) AS n FROM points QUALIFY n <= 64),
    firsts AS (SELECT min(n) AS n, p FROM head GROUP BY p),
    pivots AS (SELECT p, row_number() OVER (ORDER BY n) AS cell FROM firsts QUALIFY cell <= 16),
    away AS (SELECT vec_id, cell, floor(sqrt(greatest(0, 2 - 2 * list_inner_product(x.p, y.p))) * 1e9::DOUBLE + 0.5) AS d
             FROM points x CROSS JOIN pivots y),
    near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY d, cell) AS r FROM away)
"""


@query(f"""
    WITH {POINTS_SQL},
    pairs AS (
        SELECT q.vec_id AS token, c.vec_id AS neighbor,
               {S.grid(S.cosine('qp.v', 'cp.v'))} AS g
        FROM (SELECT * FROM near WHERE r <= 4) q JOIN (SELECT * FROM near WHERE r = 1) c USING (cell)
        JOIN points qp ON qp.vec_id = q.vec_id JOIN points cp ON cp.vec_id = c.vec_id),
    best AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY g DESC, neighbor)::INTEGER AS rank
             FROM pairs QUALIFY rank <= 10)
    SELECT token, neighbor, {S.fixed('g / 1e9::DOUBLE')} AS score, rank FROM best
""")
def ann_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate search: only the four nearest of sixteen cells are read."""
    corpus, path = D.vectors(spark, folder).withColumnRenamed("vec_id", "neighbor"), fresh_path(spark, "cells")
    build_cells(corpus, path, ["neighbor"], cells=16)
    asked = corpus.select(F.col("neighbor").alias("token"), F.col("vec").alias("query_vec"))
    return _rounded(top_k_in_cells(asked, path, 10, "token", probes=4))


@query(f"""
    SELECT a.vec_id AS w1, b.vec_id AS w2,
           {S.fixed('list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])')} AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def similarity_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every token with its successor; the last pair lacks its second word and drops out."""
    tokens = D.vectors(spark, folder).withColumnRenamed("vec_id", "token")
    pairs = tokens.select(F.col("token").alias("w1"), (F.col("token") + 1).alias("w2"))
    return stats.similarity(pairs, tokens).withColumn("cosine", V.fixed_point(F.col("cosine")))


def _analogy_sql(score: str) -> str:
    return f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    known AS (
        SELECT a.vec_id AS a, b.vec_id AS b, c.vec_id AS c,
               list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] - b.v[i] + c.v[i]) AS t
        FROM e a JOIN e b ON b.vec_id = a.vec_id + 1 JOIN e c ON c.vec_id = a.vec_id + 2),
    scored AS (SELECT a, b, c, vec_id AS predicted, {S.grid(score)} AS g
               FROM known JOIN e ON vec_id NOT IN (a, b, c)),
    best AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY g DESC, predicted) AS r FROM scored QUALIFY r = 1)
    SELECT a, b, c, predicted, {S.fixed('g / 1e9::DOUBLE')} AS cosine FROM best
    """


def _analogies(spark: SparkSession, folder: str, normalized: bool) -> DataFrame:
    """Every token with its two successors as triple; the last two lack a word and drop out."""
    tokens = D.vectors(spark, folder).withColumnRenamed("vec_id", "token")
    a = F.col("token")
    triples = tokens.select(a.alias("a"), (a + 1).alias("b"), (a + 2).alias("c"))
    found = stats.analogies(triples, tokens, normalized)
    return found.withColumn("cosine", V.fixed_point(F.col("cosine")))


@query(_analogy_sql(f"list_inner_product(t, v) / {S.norm('t')}"))
def analogy(spark: SparkSession, folder: str) -> DataFrame:
    return _analogies(spark, folder, normalized=True)


@query(_analogy_sql(S.cosine("t", "v")))
def analogy_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return _analogies(spark, folder, normalized=False)


@query("""
    SELECT vec_id::VARCHAR AS token, len(embedding)::INTEGER AS dim,
           list_min(embedding)::DOUBLE AS low, list_max(embedding)::DOUBLE AS high, embedding[1]::DOUBLE AS first
    FROM embeddings
""")
def wide_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "wide-csv")
    rows = D.vectors(spark, folder).select(F.col("vec_id").cast("string").alias("token"), "vec")
    sinks.write_wide_embeddings(rows, path)
    read = records.check_embeddings(records.wide_embeddings(spark, path))
    return read.select(
        "token", F.size("vec").alias("dim"), F.array_min("vec").cast("double").alias("low"),
        F.array_max("vec").cast("double").alias("high"), F.col("vec")[0].cast("double").alias("first"),
    )


@query(f"""
    WITH {VOCAB_SQL},
    top AS (SELECT token FROM vocab WHERE token_id < 3000),
    keyed AS (SELECT token AS word FROM top),
    {S.hash_weights('w', 'keyed', 'word', 'word')},
    n AS (SELECT word, sum(w * w) AS n FROM w GROUP BY word),
    dots AS (SELECT a.word AS token, b.word AS neighbor, sum(a.w * b.w) AS dot
             FROM w a JOIN w b ON a.d = b.d AND a.word <> b.word GROUP BY ALL),
    pairs AS (
        SELECT x.token, y.token AS neighbor, {S.grid('coalesce(dot / (sqrt(p.n) * sqrt(q.n)), 0)')} AS g
        FROM top x JOIN top y ON x.token <> y.token
        LEFT JOIN dots d ON d.token = x.token AND d.neighbor = y.token
        LEFT JOIN n p ON p.word = x.token LEFT JOIN n q ON q.word = y.token),
    near AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY g DESC, neighbor)::INTEGER AS rank
             FROM pairs QUALIFY rank <= 5)
    SELECT token, neighbor, {S.fixed('g / 1e9::DOUBLE')} AS cosine, rank FROM near
""")
def token_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabulary to token vectors to neighbour graph, for the 3000 most frequent tokens."""
    tokens = stats.frequent_tokens(D.documents(spark, folder, "text"), 3000)
    edges = stats.knn_graph(stage(stats.token_embeddings(tokens), "token-vectors"), 5)
    return edges.withColumn("cosine", V.fixed_point(F.col("cosine")))


@query(f"SELECT token, neighbor, cosine FROM ({SQL['token_neighbors']})")
def neighbors_file(spark: SparkSession, folder: str) -> DataFrame:
    """The same graph through the files of the job: vocabulary, token vectors, neighbours."""
    vocabulary, vectors, neighbors = (fresh_path(spark, name) for name in ("vocab-csv", "token-vectors-csv", "neighbors-csv"))
    stats.export_vocabulary(D.documents(spark, folder, "text"), vocabulary)
    stats.export_neighbors(spark, vocabulary, vectors, neighbors, top_n=3000, k=5)
    written = spark.read.schema("token string, neighbor string, cosine double").option("header", True).csv(neighbors)
    return written.withColumn("cosine", V.fixed_point(F.col("cosine")))


@query(f"""
    SELECT w1 AS a, w2 AS b, NULL::BIGINT AS c, NULL::BIGINT AS predicted, cosine FROM ({SQL['similarity_pairs']})
    UNION ALL SELECT a, b, c, predicted, cosine FROM ({SQL['analogy']})
""")
def evaluation_files(spark: SparkSession, folder: str) -> DataFrame:
    """Similarity and analogy through the files of the evaluation job."""
    tokens = D.vectors(spark, folder).withColumnRenamed("vec_id", "token")
    a = F.col("token")
    pairs = tokens.select(a.alias("w1"), (a + 1).alias("w2"))
    triples = tokens.select(a.alias("a"), (a + 1).alias("b"), (a + 2).alias("c"))
    similarity, analogy = fresh_path(spark, "similarity-csv"), fresh_path(spark, "analogy-csv")
    stats.evaluate(pairs, triples, tokens, similarity, analogy)
    none = F.lit(None).cast("long")
    first = spark.read.schema("w1 long, w2 long, cosine double").option("header", True).csv(similarity).select(
        F.col("w1").alias("a"), F.col("w2").alias("b"), none.alias("c"), none.alias("predicted"), "cosine")
    second = spark.read.schema("a long, b long, c long, predicted long, cosine double").option("header", True).csv(analogy)
    return first.unionByName(second).withColumn("cosine", V.fixed_point(F.col("cosine")))


RECALL_SQL = """
    WITH v AS (SELECT count(*) AS n FROM embeddings)
    SELECT n AS vectors, n * least(n - 1, 10) AS edges, true AS recall_reached FROM v
"""


def _recall(found: DataFrame, spark: SparkSession, folder: str, least: float = 0.95) -> DataFrame:
    """Vectors, edges given and whether enough of the exact edges are among them."""
    exact = _edges(spark, folder).select("token", "neighbor", F.lit(1).alias("hit"))
    met = found.select("token", "neighbor").join(exact, ["token", "neighbor"], "left")
    return met.agg(F.count_distinct("token").alias("vectors"), F.count("*").alias("edges"),
                   (F.count("hit") >= least * F.count("*")).alias("recall_reached"))


@query(RECALL_SQL)
def knn_descent_recall(spark: SparkSession, folder: str) -> DataFrame:
    """The neighbour graph by neighbour descent, held against the exact one."""
    found, _ = knn_descent(D.vectors(spark, folder).withColumnRenamed("vec_id", "token"), 10)
    return _recall(found, spark, folder)


def _quantized(spark: SparkSession, folder: str, k: int, rerank: int, **search) -> DataFrame:
    corpus, path = D.vectors(spark, folder).withColumnRenamed("vec_id", "neighbor"), fresh_path(spark, "quantized")
    build_quantized(corpus, path, ["neighbor"], cells=16)
    asked = corpus.select(F.col("neighbor").alias("token"), F.col("vec").alias("query_vec"))
    return top_k_quantized(asked, path, k, "token", rerank=rerank, **search)


@query(RECALL_SQL)
def ann_quantized_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Search over codes of 32 bytes, 48 vectors read per query, held against the exact graph."""
    near = _quantized(spark, folder, 11, 48).where(F.col("token") != F.col("neighbor"))
    place = F.row_number().over(Window.partitionBy("token").orderBy("rank"))
    return _recall(near.withColumn("place", place).where(F.col("place") <= 10), spark, folder)


@query("""
    SELECT n.n::INTEGER AS code, count(*) AS rows FROM embeddings, (VALUES (2), (4), (5), (6)) AS n(n) GROUP BY 1
""")
def embedding_table_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Tables made of the vectors that cannot be used, each refused with its code."""
    rows = D.vectors(spark, folder).select(F.col("vec_id").cast("string").alias("token"), F.array_join(F.col("vec").cast("array<string>"), " ").alias("d0"))
    bad = {
        records.BadEmbeddingTable.MISSING: None,
        records.BadEmbeddingTable.NO_TOKEN: rows.withColumnRenamed("token", "word"),
        records.BadEmbeddingTable.NO_DIMENSION: rows.select("token"),
        records.BadEmbeddingTable.NO_ROWS: rows,  # all numbers in one field
    }
    found = []
    for table in bad.values():
        path = fresh_path(spark, "bad-embeddings")
        if table is not None:
            sinks.write_csv(table, path)
        try:
            records.check_embeddings(records.wide_embeddings(spark, path))
        except records.BadEmbeddingTable as error:
            found.append(error.code)
    codes = F.explode(F.array(*[F.lit(code) for code in found]).cast("array<int>"))
    return rows.select(codes.alias("code")).groupBy("code").agg(F.count("*").alias("rows"))
