import numpy as np
import pytest

from corpuscle.operators.descent import knn_descent
from corpuscle.plans import stats


def table(spark, folder="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{folder}/embeddings.parquet").selectExpr("vec_id AS token", "embedding AS vec")


def test_recall_and_work_of_whole_tables(spark):
    work = {}
    for folder in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        rows = table(spark, folder)
        found, how = knn_descent(rows, 10)
        exact = stats.knn_graph(rows, 10)
        hits = found.join(exact, ["token", "neighbor"]).count()
        assert hits >= 0.95 * exact.count() and found.count() == exact.count()
        assert how.changed[-1] <= 0.002 * 30 * how.nodes
        work[how.nodes] = how.compared_per_node()
    # Four times the rows: brute force would compare four times as many.
    (few, a), (many, b) = sorted(work.items())
    assert many == 4 * few and b < 1.6 * a


def lists(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        found.setdefault(r["token"], []).append((r["neighbor"], r["cosine"]))
    return found


def test_scores_and_order_are_exact(spark):
    rows = table(spark, "/root/testdata/sf0.001")
    vectors = {r["token"]: np.array(r["vec"], dtype=np.float64) for r in rows.collect()}
    for token, near in lists(knn_descent(rows, 5)[0]).items():
        assert len({n for n, _ in near} - {token}) == 5
        assert near == sorted(near, key=lambda e: (-e[1], e[0]))
        for neighbor, cosine in near:
            x, y = vectors[token], vectors[neighbor]
            assert cosine == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)), abs=2e-9)


def test_copies_ties_and_vectors_without_direction(spark):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(60, 8)).round(2)
    vectors = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors += [(1000 + i, base[3].tolist()) for i in range(120)] + [(2000 + i, [0.0] * 8) for i in range(3)]
    spoilt = [(3000, None), (3001, [float("nan")] * 8), (3002, [1.0, None] * 4), (3003, [1.0] * 5), (None, base[0].tolist())]
    kind = "token long, vec array<double>"
    found, how = knn_descent(spark.createDataFrame(vectors + spoilt, kind).repartition(6), 7)
    assert how.nodes == 61
    found, exact = lists(found), lists(stats.knn_graph(spark.createDataFrame(vectors, kind), 7))
    assert found.keys() == exact.keys()
    copies = [3, *range(1000, 1120)]
    assert all(found[t] == exact[t] for t in copies) and [n for n, _ in found[1119]] == [3, *range(1000, 1006)]
    hits = sum(len({n for n, _ in found[t]} & {n for n, _ in exact[t]}) for t in range(60))
    assert hits >= 0.95 * 7 * 60


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n):
    rows = spark.createDataFrame([(f"t{i}", [1.0, float(i)]) for i in range(n)], "token string, vec array<float>")
    found, _ = knn_descent(rows, 4)
    assert found.count() == n * (n - 1)
