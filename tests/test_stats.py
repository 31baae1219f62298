import random

from pyspark.sql import functions as F

from corpuscle.operators.ranking import first_rows, with_dense_id
from corpuscle.plans import stats
from corpuscle.sources.records import wide_embeddings


def test_vocabulary(spark, tmp_path):
    docs = spark.createDataFrame([("Bug bug bug. Fix code; repository.",), ("Code repository; issue issue.",)], "text string")
    want = [("bug", 0, 3), ("code", 1, 2), ("issue", 2, 2), ("repository", 3, 2), ("fix", 4, 1)]
    assert [tuple(r) for r in stats.vocabulary(docs).orderBy("token_id").collect()] == want
    assert [tuple(r) for r in stats.frequent_tokens(docs, 3).orderBy("token_id").collect()] == want[:3]
    stats.export_vocabulary(docs, str(tmp_path / "v"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "v")).collect()]
    assert "token,token_id,freq" in lines and "bug,0,3" in lines and len(set(lines)) == 6


def test_tokens_in_overlaps_count_twice(spark):
    docs = spark.createDataFrame([("a" * 8 + " word " + "b" * 8,)], "text string")
    counted = {r.token: r.freq for r in stats.token_frequencies(docs, 14, 6).collect()}
    assert counted["word"] == 2


def test_dense_id_equals_sorted_order(spark):
    rng = random.Random(3)
    rows = [(f"t{i}", rng.choice([1, 1, 1, 2, 5])) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "token string, freq long").repartition(7)
    got = with_dense_id(df, [F.col("freq").desc(), F.col("token")], "id").orderBy("id").collect()
    assert [(r.token, r.freq) for r in got] == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r.id for r in got] == list(range(2000))
    head = first_rows(df, [F.col("freq").desc(), F.col("token")], 10, "id").orderBy("id").collect()
    assert [tuple(r) for r in head] == [tuple(r) for r in got[:10]]


def embeddings(spark):
    rows = [
        ("developer", [1.0, 0.0, 0.0]), ("code", [0.0, 1.0, 0.0]), ("bug", [0.0, 0.8, 0.6]), ("fix", [0.8, 0.0, 0.6]),
        ("issue", [0.0, 0.6, 0.8]), ("defect", [0.0, 0.8, 0.6]),
    ]
    return spark.createDataFrame(rows, "token string, vec array<float>")


def test_similarity_drops_pairs_with_unknown_words(spark):
    pairs = spark.createDataFrame([("bug", "defect"), ("repository", "repo"), ("issue", "bug")], "w1 string, w2 string")
    for normalized in (True, False):
        rows = stats.similarity(pairs, embeddings(spark), normalized).orderBy("w1").collect()
        assert [(r.w1, r.w2, round(r.cosine, 4)) for r in rows] == [("bug", "defect", 1.0), ("issue", "bug", 0.96)]


def test_analogies_exclude_their_own_words(spark):
    triples = spark.createDataFrame([("developer", "code", "bug"), ("issue", "bug", "patch"), ("developer", "code", "bug")],
                                    "a string, b string, c string")
    for normalized in (True, False):
        rows = stats.analogies(triples, embeddings(spark), normalized).collect()
        assert [(r.a, r.b, r.c, r.predicted) for r in rows] == [("developer", "code", "bug", "fix")] * 2
        assert abs(rows[0].cosine - 1.16 / 1.4 ** 0.5 * (1.4 ** 0.5) / (1 + 0.04 + 0.36) ** 0.5) < 1e-6


def test_analogy_scores_of_vectors_that_are_no_unit_vectors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.0, 1.0]), ("far", [3.0, 3.0]), ("near", [1.0, 0.0])]
    df = spark.createDataFrame(rows, "token string, vec array<float>")
    triple = spark.createDataFrame([("a", "b", "c")], "a string, b string, c string")
    by_dot, by_cosine = stats.analogies(triple, df).first(), stats.analogies(triple, df, normalized=False).first()
    assert (by_dot.predicted, by_dot.cosine) == ("far", 3.0)
    assert (by_cosine.predicted, by_cosine.cosine) == ("near", 1.0)


def test_neighbours_never_name_the_token_itself(spark):
    rows = stats.knn_graph(embeddings(spark), 2).orderBy("token", "rank").collect()
    assert len(rows) == 12 and all(r.token != r.neighbor for r in rows)
    assert [(r.neighbor, round(r.cosine, 4)) for r in rows if r.token == "bug"] == [("defect", 1.0), ("issue", 0.96)]


def test_export_chain(spark, tmp_path):
    docs = spark.createDataFrame([("bug code bug repo code bug",)], "text string")
    v, e, n, s, a = (str(tmp_path / x) for x in "vensa")
    stats.export_vocabulary(docs, v)
    stats.export_neighbors(spark, v, e, n, top_n=2, k=1)
    table = wide_embeddings(spark, e)
    assert sorted(r.token for r in table.collect()) == ["bug", "code"]
    rows = spark.read.option("header", True).csv(n).orderBy("token").collect()
    assert [(r.token, r.neighbor) for r in rows] == [("bug", "code"), ("code", "bug")]
    pairs = spark.createDataFrame([("bug", "code")], "w1 string, w2 string")
    triples = spark.createDataFrame([("bug", "code", "code")], "a string, b string, c string")
    stats.evaluate(pairs, triples, table, s, a)
    assert spark.read.option("header", True).csv(s).columns == ["w1", "w2", "cosine"]
    assert spark.read.option("header", True).csv(a).columns == ["a", "b", "c", "predicted", "cosine"]
