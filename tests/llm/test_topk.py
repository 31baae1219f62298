import math
import random

import numpy as np
import pytest

from corpuscle.llm import topk


def brute(rows, every=50, k=5):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = set()
    for q in {i for i, _ in good if i % every == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for j, v in good if j == q for i, w in good if i != q]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def searched(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    return {tuple(r) for r in topk.top_k(frame.repartition(4), **more).collect()}


def vectors(kind, count, dim=16, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(count, dim))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "norms":
        x *= np.exp(draw.normal(size=(count, 1)) * 2)
    if kind == "low rank":
        x = draw.normal(size=(count, 2)) @ draw.normal(size=(2, dim))
    if kind == "copies":
        x[: count // 3] = x[0]
        x = np.round(x)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("kind", ["unit", "norms", "low rank", "copies"])
def test_equals_brute_force_in_small_blocks(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 16 * 20)
    rows = vectors(kind, 700)
    assert searched(spark, rows, every=10) == brute(rows, every=10)


def test_vectors_that_take_no_part(spark):
    bad = [float("nan"), float("inf"), None]
    rows = vectors("norms", 120, dim=4) + [(1000 + i, [1.0, b, 2.0, 3.0]) for i, b in enumerate(bad)]
    rows += [(1050, None), (None, [9.0] * 4), (1100, []), (1101, [5.0]), (1150, [1.0, 2.0]), (1200, [0.0] * 4)]
    assert searched(spark, rows) == brute(rows)


def test_large_numbers_are_exact(spark):
    draw = random.Random(9)
    rows = [(i, [float(draw.randint(1 << 20, 1 << 21)) for _ in range(4)]) for i in range(120)]
    assert searched(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0]), (2, [2.0])], [(50, [1.0]), (7, [1.0]), (6, [1.0])], [(0, [0.0, 0.0]), (1, [0.0, 0.0])]])
def test_few_rows(spark, rows):
    assert searched(spark, rows) == brute(rows)


def test_bounds_leave_pairs_out(monkeypatch):
    """With falling lengths and a floor, later blocks are not scored at all."""
    x = np.array([v for _, v in sorted(vectors("norms", 400), key=lambda r: -np.linalg.norm(r[1]))])
    ints = np.floor(256 * x).astype(np.int64)
    turn = np.linalg.svd(ints.astype(float))[2].T
    best = topk.Winners(np.array([-1]), ints[:1], np.array([topk.NONE]), turn, 5, 4)
    best.add(np.arange(100), ints[:100], turn)
    before = best.floors.copy()
    monkeypatch.setattr(best, "_keep", lambda *found: pytest.fail("a pair was kept") if len(found[0]) else None)
    best.add(np.arange(300, 400), ints[300:], turn)
    assert (best.floors == before).all()


def test_copied_blocks_never_go_through_the_driver(spark):
    """The tables of blocks are small, their copies are not: no side of their join is broadcast."""
    frame = spark.createDataFrame(vectors("unit", 700), "vec_id long, embedding array<float>")
    plan = topk.top_k(frame, every=10)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("most", [0, 127, 128, 40_000, 1 << 31, -(1 << 62)])
def test_packed_numbers(most):
    ints = np.array([[most, -1], [0, 1], [2, 3]], dtype=np.int64)
    assert (topk._unpacked(topk._packed(ints), 3, 2) == ints).all()
