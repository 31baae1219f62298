"""Corpus statistics: vocabulary, neighbours, similarity, analogies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.functions import vectors as V
from corpuscle.operators.chunking import chunk, explode_tokens
from corpuscle.operators.embed import Embedder, embed_column
from corpuscle.operators.ranking import first_rows, with_dense_id
from corpuscle.operators.search import top_k
from corpuscle.session import stage
from corpuscle.sources.records import top_vocabulary
from corpuscle.sources.sinks import write_csv, write_wide_embeddings


def token_frequencies(docs: DataFrame, max_chars: int = 1200, overlap: int = 240) -> DataFrame:
    """Token counts over overlapping chunks, so tokens in an overlap count twice."""
    chunks = chunk(docs.select("text"), "text", max_chars, overlap)
    tokens = explode_tokens(chunks, T.vocabulary_tokens(F.col("text")), [])
    fitting = tokens.where(F.length("token").between(2, 40))
    return fitting.groupBy("token").agg(F.count("*").alias("freq"))


def by_frequency() -> list:
    return [F.col("freq").desc(), F.col("token").asc()]


def vocabulary(docs: DataFrame, max_chars: int = 1200, overlap: int = 240) -> DataFrame:
    """``token, token_id, freq`` with ids from 0 by falling frequency."""
    counted = token_frequencies(docs, max_chars, overlap)
    return with_dense_id(counted, by_frequency(), "token_id").select("token", "token_id", "freq")


def frequent_tokens(docs: DataFrame, top_n: int, max_chars: int = 1200, overlap: int = 240) -> DataFrame:
    """The head of the vocabulary without numbering the rest of it."""
    counted = token_frequencies(docs, max_chars, overlap)
    return first_rows(counted, by_frequency(), top_n, "token_id").select("token", "token_id", "freq")


def export_vocabulary(docs: DataFrame, path: str) -> None:
    write_csv(vocabulary(docs), path)


def token_embeddings(
    tokens: DataFrame, make_embedder: Callable[[], Embedder] | None = None, batch: int = 64
) -> DataFrame:
    """``token, vec`` with unit vectors; tokens the model failed on are left out."""
    embedded = embed_column(tokens.select("token"), make_embedder, "token", batch=batch)
    unit = V.l2_normalize(F.col("vec")).cast("array<float>")
    return embedded.where(F.col("vec").isNotNull()).select("token", unit.alias("vec"))


def knn_graph(embeddings: DataFrame, k: int = 10, token: str = "token", **search) -> DataFrame:
    """Edges from every token to its ``k`` nearest others.

    The vectors are read more than once; stage them first if they are costly.
    """
    queries = embeddings.select(F.col(token).alias("_from"), F.col("vec").alias("query_vec"))
    # One more than asked for: the token itself may be among the best.
    near = top_k(queries, embeddings.select(token, "vec"), k + 1, "_from", [token], **search)
    others = near.where(F.col("_from") != F.col(token))
    place = F.row_number().over(Window.partitionBy("_from").orderBy("rank"))
    return others.withColumn("_place", place).where(F.col("_place") <= k).select(
        F.col("_from").alias("token"), F.col(token).alias("neighbor"), F.col("score").alias("cosine"),
        F.col("_place").alias("rank"),
    )


def export_neighbors(
    spark: SparkSession,
    vocabulary_path: str,
    embeddings_path: str,
    neighbors_path: str,
    top_n: int = 5000,
    k: int = 10,
    make_embedder: Callable[[], Embedder] | None = None,
) -> None:
    """Vocabulary file to token-embedding file and neighbour file.

    The vectors are staged, so the model sees every token once.
    """
    embedded = stage(token_embeddings(top_vocabulary(spark, vocabulary_path, top_n), make_embedder), "token-vectors")
    write_wide_embeddings(embedded, embeddings_path)
    write_csv(knn_graph(embedded, k).select("token", "neighbor", "cosine"), neighbors_path)


def similarity(pairs: DataFrame, embeddings: DataFrame, normalized: bool = True) -> DataFrame:
    """Similarity of ``w1, w2`` pairs; pairs with a word that has no vector drop out.

    ``normalized`` takes the vectors for unit vectors and uses their dot product.
    """
    first = embeddings.select(F.col("token").alias("w1"), F.col("vec").alias("_v1"))
    second = embeddings.select(F.col("token").alias("w2"), F.col("vec").alias("_v2"))
    measure = V.dot if normalized else V.cosine
    joined = pairs.select("w1", "w2").join(first, "w1").join(second, "w2")
    return joined.select("w1", "w2", measure(F.col("_v1"), F.col("_v2")).alias("cosine"))


def analogies(triples: DataFrame, embeddings: DataFrame, normalized: bool = True, **search) -> DataFrame:
    """For ``a, b, c`` the token nearest to a - b + c that is none of the three.

    ``normalized`` scores the unit target against the vectors as they are; the
    other form is the true cosine.  Triples with an unknown word drop out.
    """
    known = triples.select("a", "b", "c").distinct()
    for word in ("a", "b", "c"):
        vectors = embeddings.select(F.col("token").alias(word), F.col("vec").alias(f"_{word}"))
        known = known.join(vectors, word)
    target = V.add(V.subtract(F.col("_a"), F.col("_b")), F.col("_c"))
    asked = known.select(
        F.struct("a", "b", "c").alias("_words"),
        (V.l2_normalize(target) if normalized else target).alias("query_vec"),
    ).withColumn("_triple", F.to_json("_words"))
    # The three words themselves may take the first three places.
    near = top_k(
        asked, embeddings.select("token", "vec"), 4, "_triple", ["token"],
        metric="dot" if normalized else "cosine", **search,
    )
    words = F.from_json("_triple", asked.schema["_words"].dataType)
    candidates = near.select(words.alias("w"), "token", "score", "rank").where(
        ~F.col("token").isin(F.col("w.a"), F.col("w.b"), F.col("w.c"))
    )
    best = candidates.groupBy("w").agg(F.min_by(F.struct("token", "score"), "rank").alias("best")).select(
        "w.a", "w.b", "w.c", F.col("best.token").alias("predicted"), F.col("best.score").alias("cosine")
    )
    return triples.select("a", "b", "c").join(best, ["a", "b", "c"])


def evaluate(
    pairs: DataFrame, triples: DataFrame, embeddings: DataFrame, similarity_path: str, analogy_path: str,
    normalized: bool = True,
) -> None:
    write_csv(similarity(pairs, embeddings, normalized), similarity_path)
    write_csv(analogies(triples, embeddings, normalized), analogy_path)
