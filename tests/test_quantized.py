import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscle.operators.quantized import WORDS, Codebook, _rough, _short, build_quantized, top_k_quantized, typical
from corpuscle.operators.search import top_k

KIND = "id long, vec array<double>, label string"


def rows(n=600, dim=16, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dim)) * 2
    return [(i, (centres[i % 12] + draw.normal(size=dim)).tolist(), f"l{i % 3}") for i in range(n)]


def answers(df):
    return {(r["q"], r["rank"]): (r["id"], r["label"], round(r["score"], 6)) for r in df.collect()}


def test_codes_are_close_and_need_a_byte_a_part():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 4))
    book = Codebook([typical(x[:, :2]), typical(x[:, 2:])], 4)
    codes = book.encode(x)
    back = np.hstack([book.words[0][codes[:, 0]], book.words[1][codes[:, 1]]])
    assert codes.dtype == np.uint8 and len(book.words[0]) <= WORDS
    assert ((x - back) ** 2).mean() < 0.02 * x.var()
    tables = book.tables(x[:5])
    by_table = np.array([[tables[q, 0, c[0]] + tables[q, 1, c[1]] for c in codes] for q in range(5)])
    assert np.allclose(by_table, x[:5] @ back.T)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_few_vectors_are_read_and_their_scores_are_exact(spark, tmp_path, metric):
    corpus = spark.createDataFrame(rows() + [(5000 + i, rows()[7][1], "copy") for i in range(200)], KIND).repartition(4)
    build_quantized(corpus, str(tmp_path / "q"), ["id"], metric=metric, cells=9, parts=8)
    asked = corpus.where("id < 60").select(F.col("id").alias("q"), F.col("vec").alias("query_vec"))
    exact = answers(top_k(asked, corpus, 10, "q", ["id"], metric=metric))
    # A whole cell of copies ties: of these the ids decide, so as many have to be read.
    found = answers(top_k_quantized(asked, str(tmp_path / "q"), 10, "q", rerank=100))
    assert found.keys() == exact.keys()
    assert len(set(found.items()) & set(exact.items())) >= 0.95 * len(exact)
    assert answers(top_k_quantized(asked, str(tmp_path / "q"), 10, "q", rerank=10_000)) == exact


def test_probes_read_the_nearest_cells(spark, tmp_path):
    corpus = spark.createDataFrame(rows(), KIND)
    build_quantized(corpus, str(tmp_path / "q"), ["id"], cells=12, parts=8)
    asked = corpus.where("id < 40").select(F.col("id").alias("q"), F.col("vec").alias("query_vec"))
    found = top_k_quantized(asked, str(tmp_path / "q"), 1, "q", probes=1).collect()
    assert all(r["q"] == r["id"] and r["score"] == pytest.approx(1) for r in found) and len(found) == 40


def test_odd_rows(spark, tmp_path):
    odd = [(1, [1.0, 0.0], "a"), (2, None, "b"), (3, [float("nan"), 1.0], "c"), (4, [0.0, 0.0], "d"), (5, [0.5, 0.5], None)]
    corpus = spark.createDataFrame(odd, KIND)
    build_quantized(corpus, str(tmp_path / "q"), ["id"], cells=2)
    asked = corpus.select(F.col("id").alias("q"), F.col("vec").alias("query_vec"))
    assert answers(top_k_quantized(asked, str(tmp_path / "q"), 9, "q")) == answers(top_k(asked, corpus, 9, "q", ["id"]))
    assert top_k_quantized(asked.limit(0), str(tmp_path / "q"), 9, "q").count() == 0
    with pytest.raises(ValueError):
        build_quantized(corpus, str(tmp_path / "r"), ["id"], metric="euclidean")


def test_short_lists_hold_the_best_rows_by_their_codes():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(5000, 8))
    book = Codebook([typical(x[:, p:p + 2]) for p in range(0, 8, 2)], 8)
    codes, queries = book.encode(x), draw.normal(size=(20, 8))
    near = np.stack([sum(t[p, codes[:, p]] for p in range(4)) for t in book.tables(queries)])
    found, cols = _short(queries, _rough(book.decode(codes)), len(x), 12)
    assert len(cols) < near.size // 20
    for q in range(20):
        kth = np.sort(near[q])[-12]
        assert set(np.flatnonzero(near[q] > kth)) <= set(cols[found == q]) and (found == q).sum() >= 12
