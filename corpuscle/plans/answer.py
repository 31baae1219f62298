"""Questions to retrieved chunks, guards, prompts and cleaned answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.functions.binding import bind
from corpuscle.operators.embed import Embedder, embed_column
from corpuscle.operators.search import top_k, top_k_in_cells
from corpuscle.plans.index import answerable
from corpuscle.sources.records import current_build


def retrieve(
    questions: DataFrame,
    index: DataFrame,
    k: int = 8,
    fetch: int = 8,
    make_embedder: Callable[[], Embedder] | None = None,
    metric: str = "euclidean",
    **search,
) -> DataFrame:
    """The ``k`` best chunks per question of ``question_id, question``.

    Each shard yields ``max(fetch, k)`` candidates, which are then merged.  The
    default score is 1 / (1 + squared distance); ``metric="cosine"`` ranks by
    angle instead.
    Chunks without text are left out, missing ids named.
    """
    asked = _asked(questions, make_embedder)
    hits = top_k(asked, answerable(index), k, "question_id", ["doc_id", "chunk_order"], metric=metric,
                 shard="shard", fetch=fetch, **search)
    return _labelled(hits)


def retrieve_from(
    questions: DataFrame,
    path: str,
    k: int = 8,
    fetch: int = 8,
    make_embedder: Callable[[], Embedder] | None = None,
    probes: int | None = None,
) -> DataFrame:
    """As ``retrieve``, from the cells of the index ``build_index`` has written to ``path``.

    Only visited cells are read: the ``probes`` nearest of each question, or without
    ``probes`` as many as it takes to be exact.
    """
    asked = _asked(questions, make_embedder)
    cells = f"{current_build(questions.sparkSession, path)}/cells"
    return _labelled(top_k_in_cells(asked, cells, k, "question_id", probes=probes, shard="shard", fetch=fetch))


def _asked(questions: DataFrame, make_embedder: Callable[[], Embedder] | None) -> DataFrame:
    return embed_column(questions.select("question_id", "question"), make_embedder, "question", "query_vec")


def _labelled(hits: DataFrame) -> DataFrame:
    return hits.select(
        "question_id", "rank", "doc_id", "chunk_id",
        T.hit_label(F.col("doc_id"), F.col("chunk_id")).alias("label"), "score", "text",
    )


def keyword_overlap(question: Column, contexts: Column) -> Column:
    """Question keywords, repeats counted, that occur in any of the context texts."""
    words = T.without_stop_words(T.keywords(F.array_join(contexts, " ")))
    asked = T.without_stop_words(T.keywords(question))
    return bind(
        F.array_distinct(words),
        lambda seen: F.size(F.filter(asked, lambda token: F.array_contains(seen, token))),
    )


def guard(
    questions: DataFrame, hits: DataFrame, min_top_score: float = 0.35, min_keyword_overlap: int = 1
) -> DataFrame:
    """Per question: hit count, top score, keyword overlap and whether to answer.

    ``contexts`` and ``labels`` hold the hits in rank order, at most k of them.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", "label", "text")))
    grouped = hits.groupBy("question_id").agg(F.max("score").alias("top"), ranked.alias("ranked"))
    joined = questions.select("question_id", "question").join(grouped, "question_id", "left")
    found = F.coalesce("ranked", F.array().cast("array<struct<rank:int,label:string,text:string>>"))
    full = joined.select(
        "question_id", "question",
        F.size(found).alias("n_hits"),
        F.coalesce("top", F.lit(0.0)).alias("top_score"),
        F.transform(found, lambda hit: hit.text).alias("contexts"),
        F.transform(found, lambda hit: hit.label).alias("labels"),
    ).withColumn("overlap", keyword_overlap(F.col("question"), F.col("contexts")))
    refused = (
        (F.col("n_hits") == 0)
        | (F.col("top_score") < min_top_score)
        | (F.col("overlap") < min_keyword_overlap)
    )
    return full.withColumn("answered", ~refused)


def prompts(guarded: DataFrame) -> DataFrame:
    """The prompt of every question that passed the guard."""
    return guarded.where("answered").select(
        "question_id", T.prompt(F.col("question"), F.col("contexts")).alias("prompt"), "labels"
    )


def refusals(guarded: DataFrame, refusal: str = T.REFUSAL) -> DataFrame:
    return guarded.where(~F.col("answered")).select("question_id", F.lit(refusal).alias("answer"))


def source_list(guarded: DataFrame) -> DataFrame:
    """Number and label of every source of the answered questions."""
    return guarded.where("answered").select("question_id", F.posexplode("labels").alias("at", "label")).select(
        "question_id", (F.col("at") + 1).alias("n"), "label"
    )


def clean_answers(answers: DataFrame, answer: str = "answer", max_n: str = "n_hits") -> DataFrame:
    """Model output with refusal lines, blank runs and citations out of range removed."""
    cleaned = T.drop_bad_citations(T.clean_answer(F.col(answer)), F.col(max_n))
    return answers.withColumn(answer, cleaned)
