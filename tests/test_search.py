import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuscle.operators import scoring
from corpuscle.operators.cells import build_cells, temporary_cells
from corpuscle.operators.search import _CellSearch, _lots, _Scan, top_k, top_k_in_cells, top_k_single

DIM = 8


def make_corpus(seed, n, copies=0.0, dim=DIM):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    vectors = centers[rng.integers(0, 5, n)] + 0.1 * rng.normal(size=(n, dim))
    vectors[: int(n * copies)] = centers[0]
    return vectors.astype(np.float32)


def frame(spark, vectors, id_name, vec_name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{id_name} long, {vec_name} array<float>").repartition(3)


def brute(queries, corpus, k, metric):
    out = []
    for qi, q in enumerate(queries):
        scored = []
        for ci, c in enumerate(corpus):
            q64, c64 = np.asarray(q, np.float64), np.asarray(c, np.float64)
            m = min(len(q64), len(c64))
            dot = float(q64[:m] @ c64[:m])
            scale = float(np.linalg.norm(q64) * np.linalg.norm(c64))
            if metric == "dot":
                s = dot
            elif metric == "euclidean":
                s = 1 / (1 + float(((q64 - c64) ** 2).sum()))
            elif scale == 0 or (metric == "cosine_strict" and len(q64) != len(c64)):
                s = 0.0
            else:
                s = dot / scale
            scored.append((-np.floor(s * 1e9 + 0.5), ci))
        out += [(qi, rank + 1, ci, -g / 1e9) for rank, (g, ci) in enumerate(sorted(scored)[:k])]
    return pd.DataFrame(out, columns=["qid", "rank", "id", "score"])


def collected(hits):
    return hits.select("qid", "rank", "id", "score").orderBy("qid", "rank").toPandas()


def check(got, want):
    assert got[["qid", "rank"]].values.tolist() == want[["qid", "rank"]].values.tolist()
    np.testing.assert_allclose(got.score, want.score, atol=2e-9)
    # Neighbouring grid points may swap by the last bit; the ids must agree otherwise.
    assert (got.id.values == want.id.values).mean() > 0.995


FORMS = {
    "scan": {},
    "scan_without_floor": {"floor_rows": 0},
    "scan_in_groups": {"group_queries": 3},
    "cells": {"form": "cells", "cells": 7, "block_bytes": 25 * 8 * DIM},
    "one_cell": {"form": "cells", "cells": 1},
    "derived_cells": {"form": "cells"},
}


@pytest.mark.parametrize(
    "form,metric",
    [(f, m) for f in ("scan", "scan_without_floor", "scan_in_groups", "cells") for m in ("cosine", "euclidean", "dot")] + [("one_cell", "cosine")],
)
def test_exact_search_equals_brute_force(spark, metric, form):
    corpus, queries = make_corpus(1, 240), make_corpus(2, 25)
    hits = top_k(frame(spark, queries, "qid", "query_vec"), frame(spark, corpus, "id", "vec"), 7, "qid", ["id"],
                 metric=metric, **FORMS[form])
    check(collected(hits), brute(queries, corpus, 7, metric))


@pytest.mark.parametrize("form", FORMS)
def test_a_third_of_the_rows_being_one_vector_keeps_ids_in_order(spark, form):
    corpus, queries = make_corpus(3, 300, copies=1 / 3), make_corpus(4, 10)
    queries[:5] = corpus[0]
    hits = top_k(frame(spark, queries, "qid", "query_vec"), frame(spark, corpus, "id", "vec"), 12, "qid", ["id"],
                 **FORMS[form])
    got = collected(hits)
    assert got[got.qid == 0].id.tolist() == list(range(12))
    check(got, brute(queries, corpus, 12, "cosine"))


@pytest.mark.parametrize("form", ["scan", "cells"])
@pytest.mark.parametrize("metric", ["cosine", "cosine_strict"])
def test_unequal_lengths_and_zero_vectors(spark, form, metric):
    corpus = [list(v) for v in make_corpus(5, 120)]
    for i in range(0, 120, 5):
        corpus[i] = corpus[i][:3]
    for i in range(1, 120, 10):
        corpus[i] = corpus[i] + [2.0, -1.0]
    for i in range(2, 120, 10):
        corpus[i] = [0.0] * DIM
    corpus[3] = []
    queries = [list(v) for v in make_corpus(6, 6)] + [[0.0] * DIM]
    hits = top_k(frame(spark, queries, "qid", "query_vec"), frame(spark, corpus, "id", "vec"), 90, "qid", ["id"],
                 metric=metric, **FORMS[form])
    check(collected(hits), brute(queries, corpus, 90, metric))


def test_fewer_rows_than_k_and_missing_vectors(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id long, vec array<float>")
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "qid long, query_vec array<float>")
    for options in FORMS.values():
        got = top_k(queries, corpus, 5, "qid", ["id"], **options).orderBy("rank").collect()
        assert [(r.qid, r.id, r.score) for r in got] == [(0, 1, 1.0), (0, 3, 0.0)]


def test_empty_sides_give_no_rows(spark):
    some = frame(spark, make_corpus(7, 4), "id", "vec")
    none = some.where("id < 0")
    asked = some.select(F.col("id").alias("qid"), F.col("vec").alias("query_vec"))
    for options in FORMS.values():
        assert top_k(asked, none, 3, "qid", ["id"], **options).count() == 0
        assert top_k(asked.where("qid < 0"), some, 3, "qid", ["id"], **options).count() == 0


def test_string_ids_and_payload(spark):
    corpus = spark.createDataFrame(
        [("b", 10, "x", [1.0, 0.0]), ("b", 9, "y", [1.0, 0.0]), ("a", 11, "z", [1.0, 0.0])],
        "doc string, n long, text string, vec array<float>",
    )
    queries = spark.createDataFrame([("q", [2.0, 0.0])], "qid string, query_vec array<float>")
    for options in FORMS.values():
        rows = top_k(queries, corpus, 2, "qid", ["doc", "n"], **options).orderBy("rank").collect()
        assert [(r.doc, r.n, r.text, r["rank"]) for r in rows] == [("a", 11, "z", 1), ("b", 9, "y", 2)]


@pytest.mark.parametrize("shards,form", [(1, "scan"), (3, "scan"), (8, "scan"), (3, "cells")])
def test_shards_do_not_change_the_result(spark, shards, form):
    corpus, queries = make_corpus(8, 200), make_corpus(9, 8)
    sharded = frame(spark, corpus, "id", "vec").withColumn("shard", (F.col("id") % shards).cast("int"))
    asked = frame(spark, queries, "qid", "query_vec")
    hits = top_k(asked, sharded, 5, "qid", ["id"], shard="shard", fetch=2, **FORMS[form])
    check(collected(hits), brute(queries, corpus, 5, "cosine"))


def test_floor_lets_tasks_emit_less(spark):
    corpus, queries = make_corpus(17, 2000), make_corpus(18, 5)
    few = frame(spark, queries, "qid", "query_vec").toArrow()
    rows = frame(spark, corpus, "id", "vec").repartition(20)
    scan = _Scan(few, rows, 5, "qid", "query_vec", ["id"], "vec", "cosine")
    floor = scan.floor(400)
    assert np.isfinite(floor).all() and scan.hits(floor).count() < scan.hits().count() / 2
    assert not np.isfinite(scan.floor(0)).any() and not np.isfinite(scan.floor(3)).any()


def test_late_visits_emit_only_what_reaches_the_kth_score_and_no_text(spark):
    corpus, queries = make_corpus(19, 900), make_corpus(20, 30)
    rows = frame(spark, corpus, "id", "vec").withColumn("text", F.lit("x" * 100))
    asked = frame(spark, queries, "qid", "query_vec")
    table = temporary_cells(rows, ["id"], "vec", "cosine", 12, DIM, apart=True)
    search = _CellSearch(asked, table, 5, "qid", "query_vec", None, 1 << 20)
    hits = search.exact()
    assert "text" not in hits.columns
    kth = brute(queries, corpus, 5, "cosine").groupby("qid").score.min()
    late = hits.toPandas().groupby("qid").apply(lambda g: g.sort_values("_score", ascending=False).iloc[5:], include_groups=False)
    early = hits.toPandas().groupby("qid")["_score"].nlargest(5)
    assert len(early) == 150 and len(late) < 150
    everything = top_k(asked, rows, 5, "qid", ["id"], form="cells", cells=12)
    assert everything.columns == ["qid", "id", "text", "score", "rank"] and {r.text for r in everything.collect()} == {"x" * 100}
    assert (collected(everything).groupby("qid").score.min() - kth).abs().max() < 3e-9


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("metric", ["cosine", "cosine_strict", "euclidean", "dot"])
def test_vectors_that_are_not_finite_take_no_part(spark, form, metric):
    corpus, queries = make_corpus(21, 200), make_corpus(22, 6)
    bad = {3: float("nan"), 40: float("inf"), 77: float("-inf"), 100: None, 101: float("nan"), 150: None}
    rows = [(i, [None if bad[i] is None else bad[i] if j == 2 else float(x) for j, x in enumerate(v)] if i in bad else v.tolist())
            for i, v in enumerate(corpus)]
    rows[150] = (150, [*corpus[150].tolist()[:-1], None])
    asked = [(i, v.tolist()) for i, v in enumerate(queries)] + [(6, [float("nan")] * DIM), (7, [None] * DIM)]
    hits = top_k(spark.createDataFrame(asked, "qid long, query_vec array<float>"),
                 spark.createDataFrame(rows, "id long, vec array<float>").repartition(3), 9, "qid", ["id"], metric=metric, **FORMS[form])
    good = [i for i in range(200) if i not in bad]
    want = brute(queries, corpus[good], 9, metric)
    want["id"] = [good[i] for i in want.id]
    check(collected(hits), want)


def test_overflowing_and_wrong_length_vectors_agree_in_all_forms(spark):
    rows = [(i, [1e200 * (i % 3), 1.0, float(i)]) for i in range(60)] + [(60, [1.0]), (61, []), (62, [1.0, 2.0, 3.0, 4.0])]
    corpus = spark.createDataFrame(rows, "id long, vec array<double>").repartition(3)
    asked = spark.createDataFrame([(0, [1.0, 1.0, 1.0]), (1, [0.0, 0.0, -1.0])], "qid long, query_vec array<double>")
    for metric in ("cosine", "cosine_strict", "dot"):
        found = [collected(top_k(asked, corpus, 8, "qid", ["id"], metric=metric, **options)).values.tolist() for options in FORMS.values()]
        assert all(f == found[0] for f in found) and all(r[2] % 3 == 0 or r[2] >= 60 for r in found[0])


def test_single_query_form(spark):
    corpus, query = make_corpus(10, 80), make_corpus(11, 1)
    rows = top_k_single(frame(spark, corpus, "id", "vec"), query[0].tolist(), 6, ["id"]).collect()
    assert [r.id for r in rows] == brute(query, corpus, 6, "cosine").id.tolist()


def test_approximate_search_recall_grows_to_one(spark):
    corpus, queries = make_corpus(12, 400), make_corpus(13, 20)
    asked, rows = frame(spark, queries, "qid", "query_vec"), frame(spark, corpus, "id", "vec")
    exact = brute(queries, corpus, 10, "cosine")

    def recall(probes):
        got = collected(top_k(asked, rows, 10, "qid", ["id"], cells=8, probes=probes))
        return len(got.merge(exact, on=["qid", "id"])) / len(exact)

    some, most, all_cells = recall(1), recall(3), recall(8)
    assert 0.2 < some <= most <= all_cells and all_cells > 0.995


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_written_split_is_searched_exactly_and_read_by_cell(spark, tmp_path, metric):
    corpus, queries = make_corpus(15, 300, copies=1 / 3), make_corpus(16, 12)
    path = str(tmp_path / "cells")
    build_cells(frame(spark, corpus, "id", "vec"), path, ["id"], metric=metric, cells=6, apart=True)
    asked = frame(spark, queries, "qid", "query_vec")
    check(collected(top_k_in_cells(asked, path, 5, "qid")), brute(queries, corpus, 5, metric))
    one = top_k_in_cells(asked.where("qid = 0"), path, 5, "qid", probes=1)
    assert one.count() == 5
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_cell#", plan)
    wrong = spark.createDataFrame([(0, [1.0])], "qid long, query_vec array<float>")
    with pytest.raises(ValueError):
        top_k_in_cells(wrong, path, 5, "qid")


def test_mixed_query_dimensions_are_refused(spark):
    queries = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "qid long, query_vec array<float>")
    corpus = frame(spark, make_corpus(14, 5), "id", "vec")
    for options in FORMS.values():
        with pytest.raises(ValueError):
            top_k(queries, corpus, 1, "qid", ["id"], **options).collect()


def test_bad_arguments(spark):
    corpus = frame(spark, make_corpus(14, 5), "id", "vec")
    asked = corpus.select(F.col("id").alias("qid"), F.col("vec").alias("query_vec"))
    with pytest.raises(ValueError):
        top_k(asked, corpus, 0, "qid", ["id"])
    with pytest.raises(ValueError):
        top_k(asked, corpus, 1, "qid", ["id"], metric="manhattan")


@pytest.mark.parametrize("metric", ["cosine", "cosine_strict", "dot"])
def test_rough_scores_lose_no_row(metric, monkeypatch):
    draw = np.random.default_rng(8)
    corpus = draw.standard_normal((3000, 16)) * 2.0 ** draw.integers(-1, 2, 3000)[:, None]
    corpus[::40] = corpus[0]  # copies tie
    corpus[2005] = 0.0
    table = pa.table({"id": pa.array(range(3000)), "vec": pa.array(list(corpus), pa.list_(pa.float64()))})

    def best():
        winners = scoring.Winners(scoring.Vectors(table.column("vec").slice(0, 300)), 6, metric, ["id"])
        for at in range(0, 3000, 1500):
            winners.offer(table.slice(at, 1500), "vec")
        found = winners.result()
        return list(zip(*(found.column(c).to_pylist() for c in ("_query", "_score", "id"))))

    scored = []
    whole = scoring.score
    monkeypatch.setattr(scoring, "score", lambda q, part, b, m: scored.append(part.stop - part.start) or whole(q, part, b, m))
    quick = best()
    assert sum(scored) < 2 * 300  # some queries at least were not scored against every row
    monkeypatch.setattr(scoring.Block, "_roughly", lambda self, metric: None)
    assert quick == best()


def test_many_groups_of_queries_are_one_lot(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(500)], "qid long, query_vec array<double>")
    lots = list(_lots(few, "query_vec", 10, 64 << 20))
    assert [last for _, last in lots] == [True] and sorted(lots[0][0].column("qid").to_pylist()) == list(range(500))
