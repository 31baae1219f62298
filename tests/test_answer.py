from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.plans import answer


def setup(spark):
    questions = spark.createDataFrame(
        [(1, "where is the bug"), (2, "weak bug"), (3, "unrelated words"), (4, "bug bug fix")],
        "question_id long, question string",
    )
    hits = spark.createDataFrame(
        [(2, 1, "d#0", 0.34, "bug"), (3, 1, "d#1", 0.9, "the what of"), (4, 2, "d#3", 0.5, "fix it"), (4, 1, "d#2", 0.8, "a bug")],
        "question_id long, rank int, label string, score double, text string",
    )
    return questions, hits


def test_guard_refuses_on_each_ground(spark):
    rows = answer.guard(*setup(spark)).orderBy("question_id").collect()
    assert [(r.n_hits, r.top_score, r.overlap, r.answered) for r in rows] == [
        (0, 0.0, 0, False), (1, 0.34, 1, False), (1, 0.9, 0, False), (2, 0.8, 3, True),
    ]
    strict = answer.guard(*setup(spark), min_top_score=0.3, min_keyword_overlap=4).where("answered")
    assert strict.count() == 0


def test_prompts_sources_refusals(spark):
    guarded = answer.guard(*setup(spark))
    row = answer.prompts(guarded).first()
    assert "[1] a bug\n---\n[2] fix it\n" in row.prompt and "[1..2]" in row.prompt
    assert [tuple(r) for r in answer.source_list(guarded).orderBy("n").collect()] == [(4, 1, "d#2"), (4, 2, "d#3")]
    assert {r.answer for r in answer.refusals(guarded).collect()} == {T.REFUSAL}
    assert answer.refusals(guarded).count() == 3


def test_clean_answers(spark):
    df = spark.createDataFrame([("fine [1] [5]\nI don't know based on the MSR corpus.", 2)], "answer string, n_hits int")
    assert answer.clean_answers(df).first().answer == "fine [1] "


def test_retrieve_names_missing_ids_and_drops_empty_texts(spark):
    def build():
        return lambda texts: [[1.0, 0.0] for _ in texts]

    index = spark.createDataFrame(
        [(0, "d", 10, "ten", [1.0, 0.0]), (0, "d", 9, "nine", [1.0, 0.0]), (1, None, None, "lost", [0.5, 0.5]), (1, "e", 0, "", [1.0, 0.0])],
        "shard int, doc_id string, chunk_id long, text string, vec array<float>",
    )
    questions = spark.createDataFrame([(1, "q")], "question_id long, question string")
    hits = answer.retrieve(questions, index, 8, 8, build, metric="cosine").orderBy("rank")
    assert [r.label for r in hits.collect()] == ["d#9", "d#10", "unknown.pdf#?"]
    assert hits.select(F.round("score", 4)).collect()[2][0] == 0.7071
    by_distance = answer.retrieve(questions, index, 1, 1, build).first()
    assert (by_distance.label, by_distance.score) == ("d#9", 1.0)
