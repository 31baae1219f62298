import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpuscle.llm import classifier

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(docs, labels)
    scored = classifier.score(docs, model)
    assert scored.count() == docs.count()
    rows = [r for r in scored.join(labels, "doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert len(rows) > 50 and right >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = (spark.read.parquet("/root/testdata/sf0.001/%s.parquet" % t) for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - quality, quality) AS quality")
    a, b = classifier.fit(docs, labels), classifier.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)
    joined = classifier.BROADCAST_LABELS
    try:
        classifier.BROADCAST_LABELS = 0
        c = classifier.fit(docs, labels)
    finally:
        classifier.BROADCAST_LABELS = joined
    assert np.allclose(a.weights, c.weights)


def test_features_are_sets_of_ngrams_of_one_text():
    texts = ["", "one two three", "one two three one two three", "ABC!! d", " \n"]
    doc, feature = classifier.features(pa.array(texts))
    alone = [set(classifier.features(pa.array([t]))[1].tolist()) for t in texts]
    assert [set(feature[doc == i].tolist()) for i in range(len(texts))] == alone
    assert len(doc) == sum(map(len, alone)) and not alone[0] and not alone[4] and alone[1] <= alone[2]


def test_dual_coordinate_descent_meets_the_primal():
    draw = np.random.default_rng(0)
    labels = np.where(draw.random(80) < 0.5, 1.0, -1.0)
    rows = [np.arange(6)] * 80
    values = [draw.normal(size=6) + 0.8 * y for y in labels]
    x = np.hstack([np.array(values), np.ones((80, 1))])
    primal = lambda w: 0.5 * w @ w + np.maximum(0, 1 - labels * (x @ w)).sum()
    found = classifier.descend(rows, values, labels, 6, passes=2000)
    best = min(primal(found + draw.normal(size=7) * s) for s in (0.3, 0.03, 0.003) for _ in range(300))
    assert primal(found) <= best + 1e-2


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 7)], [(None, 1)], [(1, 1)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b c", 2), (2, None, 2), (None, "", 2), (1, "a b c", 2)], "doc_id long, text string, score int")
    model = classifier.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = classifier.score(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert classifier.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("sample", [1, 5, 10_000])
def test_fit_and_scores_equal_plain_ones(spark, sample):
    """Ids are strings, one document makes up a third of all rows, and the sample bounds rows, not keys."""
    rows = [("hot", "same words again")] * 40 + [(f"d{i}", f"good line number {i} ." if i % 2 else f"BAD ## {i} !!") for i in range(80)]
    known = [("hot", 1)] + [(f"d{i}", i % 2) for i in range(80)]
    docs, labels = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(known, "doc_id string, quality int")
    model = classifier.fit(docs.repartition(5), labels, sample=sample)

    kept = [(k, t, dict(known)[k]) for k, t in rows if zlib.crc32(k.encode()) % 4 != 2]
    bag = lambda t: np.sort(classifier.features(pa.array([t]))[1])
    counts = np.ones((2, classifier.FEATURES))
    for _, text, label in kept:
        counts[label][bag(text)] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    chosen = sorted((md5(f"{k}|{md5(t)}"), label, t) for k, t, label in kept)[:sample]
    bags = [bag(t) for _, _, t in chosen]
    values = [ratio[b] / max(np.sqrt((ratio[b] ** 2).sum()), 1e-12) for b in bags]
    good = np.array([label == 1 for _, label, _ in chosen])
    solved = classifier.descend(bags, values, np.where(good, 1.0, -1.0), classifier.FEATURES)
    slope, shift = classifier._calibrated(np.array([solved[b] @ v for b, v in zip(bags, values)]) + solved[-1], good)
    for row in classifier.score(docs, model, text="text").join(docs.distinct(), "doc_id").collect():
        b = bag(row["text"])
        margin = solved[:-1][b] @ (ratio[b] / max(np.sqrt((ratio[b] ** 2).sum()), 1e-12)) + solved[-1]
        assert abs(row["score"] - 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))) < 1e-6
