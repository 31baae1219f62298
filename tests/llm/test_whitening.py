import math
from collections import Counter

import numpy as np
import pytest

from corpuscle.llm import whitening

FOLDER = "/root/testdata/sf0.01"


def brute(rows, components=16, counted=False):
    """Plain numpy over (key, vector): covariance of the distinct x, one row per key and component."""
    usable = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(k, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for k, v in usable]
    counts = Counter(x for _, x in whole)
    x = np.array(list(counts), dtype=np.float64)
    w = np.array([counts[tuple(map(int, r))] if counted else 1 for r in x], dtype=np.float64)
    n = int(w.sum())
    sums = [sum(int(c) * v[d] for v, c in zip(counts, w)) for d in range(x.shape[1])]
    mean = np.array([s / n for s in sums])
    matrix = ((x - mean) * w[:, None]).T @ (x - mean) / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for k, v in whole:
        z = (np.array(v) - mean) @ vectors / np.sqrt(values)
        far = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        out[k] = (n, far, z, values / np.trace(matrix))
    return out


def held(rows, want, components=16):
    assert len(rows) == len(want) * components
    signs = {}
    for r in rows:
        n, far, z, share = want[r["vec_id"]]
        at = r["component"] - 1
        assert (r["n"], int(r["deviation"])) == (n, far)
        assert r["explained"] == pytest.approx(share[at], rel=1e-6) and r["identity_error"] <= 1e-6
        if abs(z[at]) > 1e-3:
            signs.setdefault(at, set()).add(r["whitened"] * z[at] > 0)
            assert abs(r["whitened"]) == pytest.approx(abs(z[at]), rel=1e-5, abs=1e-6)
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    held(whitening.whiten(table).collect(), brute(rows))


KIND = "vec_id long, embedding array<float>, component int, digest string, N int"


@pytest.mark.parametrize("counted", [False, True])
def test_copies_weigh_one_or_their_number(spark, counted):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=5).astype(np.float32).tolist(), 0, "x", 1) for i in range(60)]
    rows += [(100 + i, rows[0][1], 0, "x", 1) for i in range(300)]
    rows += [(900, None, 0, "x", 1), (901, [1.0, None, 1.0, 1.0, 1.0], 0, "x", 1), (902, [float("nan")] * 5, 0, "x", 1),
             (903, [float("inf")] + [1.0] * 8, 0, "x", 1), (904, [], 0, "x", 1)]
    got = whitening.whiten(spark.createDataFrame(rows, KIND), counted=counted).collect()
    held(got, brute([(r[0], r[1]) for r in rows], 5, counted), 5)
    assert got[0]["n"] == (360 if counted else 60)


def test_nothing_is_lost_to_a_far_mean(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (1e8 + draw.integers(-3, 4, size=4)).tolist(), 0, "x", 1) for i in range(200)]
    table = spark.createDataFrame(rows, KIND.replace("float", "double"))
    held(whitening.whiten(table).collect(), brute([(r[0], r[1]) for r in rows], 4), 4)


def test_exact_beyond_64_bits(spark):
    rows = [(1, [2.0**33, 0.0], 0, "x", 1), (2, [-(2.0**33), 1.0], 0, "x", 1), (3, [5.0, 3.0], 0, "x", 1), (4, [2.0**40, 1.0], 0, "x", 1)]
    got = whitening.whiten(spark.createDataFrame(rows, KIND.replace("float", "double"))).collect()
    want = brute([(r[0], r[1]) for r in rows[:3]], 2)
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == {(k, v[1]) for k, v in want.items()}
    assert max(int(r["deviation"]) for r in got) > 2**63


def test_no_variance_no_rows(spark):
    empty = spark.createDataFrame([], KIND)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, "x", 1)] * 3, KIND)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0], 0, "x", 1) for i in range(9)] + [(None, [3.0, 2.0], 0, "x", 1)] * 2, KIND)
    rows = whitening.whiten(flat).collect()
    assert len(rows) == 11 and {r["component"] for r in rows} == {1} and rows[0]["explained"] == pytest.approx(1)
