"""Quality scores by Naive Bayes support vectors.

A text is the set of its hashed n-grams: its words, and one, two and three tokens in a
row, where a token is the shape of a word (letters by case, digits, marks as they are)
and whether the word repeats the one before.  Each n-gram is scaled by the log of the
ratio of its smoothed counts in good and in bad texts, texts are brought to length one,
and a linear hinge-loss model is fitted to them by dual coordinate descent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import pieces, without

FEATURES = 1 << 17
SMOOTHING = 1.0
COST = 1.0
PASSES = 20
SAMPLE = 6000  # labelled documents that the hinge-loss model is fitted to; counts use them all
THRESHOLD = 0.7
BROADCAST_LABELS = 2_000_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per feature: hinge-loss weight times log-count ratio
    scales: np.ndarray  # per feature: square of the log-count ratio, for the length of a text
    bias: float
    slope: float
    shift: float


def _hashed(*codes: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers of rows of hashed tokens."""
    mixed = np.full(len(codes[0]), kind + 1, dtype=np.uint64)
    for turn, code in enumerate(codes):
        mixed = (mixed ^ code) * MIX[turn]
        mixed ^= mixed >> np.uint64(29)
    return ((mixed * MIX[0]) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _crc(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def _shapes(words: pa.Array) -> pa.Array:
    out = pc.replace_substring_regex(words, r"\p{N}+", "0")
    out = pc.replace_substring_regex(out, r"\p{Lu}+", "A")
    return pc.replace_substring_regex(out, r"[^A0\p{P}\p{S}]+", "a")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and feature number of every distinct n-gram of every text, by document."""
    lists = pc.ascii_split_whitespace(texts)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    real = pc.greater(pc.binary_length(flat), 0)
    flat, doc = flat.filter(real), doc[real.to_numpy(zero_copy_only=False)]
    if not len(flat):
        return doc, doc
    coded = flat.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False)
    shape = _crc(_shapes(coded.dictionary))[word]
    again = np.zeros(len(word), dtype=np.uint64)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    token = shape * np.uint64(2) + again
    found = [doc * FEATURES + _hashed(_crc(coded.dictionary), kind=0)[word], doc * FEATURES + _hashed(token, kind=1)]
    for n in (2, 3):
        if len(word) >= n:
            starts = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1:])
            found.append(doc[starts] * FEATURES + _hashed(*(token[starts + i] for i in range(n)), kind=n))
    keys = np.sort(pa.array(np.concatenate([pc.unique(pa.array(f)).to_numpy(zero_copy_only=False) for f in found])).unique().to_numpy(zero_copy_only=False))
    return keys // FEATURES, keys % FEATURES


def held_out(key: Column) -> Column:
    """Rows kept from fitting: CRC-32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either label have each feature, over one task."""
    counts = np.zeros((2, FEATURES), dtype=np.int64)
    for batch in batches:
        for part in pieces(batch, "text"):
            doc, feature = features(part.column("text").cast(pa.string()))
            label = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            for k in (0, 1):
                counts[k] += np.bincount(feature[label[doc] == k], minlength=FEATURES)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["feature", "bad", "good"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            doc, feature = features(part.column("text").cast(pa.string()))
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("rank"), part.column("label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))],
                names=["rank", "label", "features"],
            )


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int, cost: float = COST, passes: int = PASSES) -> np.ndarray:
    """Weights (the last one the bias) of the hinge-loss model, by dual coordinate descent."""
    weights, alpha = np.zeros(size + 1), np.zeros(len(rows))
    lengths = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(passes):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = labels[i] * (weights[rows[i]] @ values[i] + weights[size]) - 1.0
            fresh = min(max(alpha[i] - gradient / lengths[i], 0.0), cost)
            step = (fresh - alpha[i]) * labels[i]
            if step:
                weights[rows[i]] += step * values[i]
                weights[size] += step
                largest = max(largest, abs(step))
                alpha[i] = fresh
        if largest < 1e-3:
            break
    return weights


def _calibrated(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton's method on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the rows of ``labels`` that are not held out.

    Feature counts are taken over all labelled documents, in the tasks, and summed by
    feature: at most ``FEATURES`` rows reach the driver.  The hinge-loss model is fitted
    to the ``sample`` labelled documents with the smallest MD5 of key and text, or to all if
    they are fewer; no more rows than that reach the driver, however often a key or a
    whole document is repeated.  Keys may be of any type that has a text form.
    Labels other than 0 and 1 and null keys are ignored, repeated label rows count as
    often as they are, null texts are empty.  Without labelled documents every score is
    one half.  Labels are broadcast if they are at most ``BROADCAST_LABELS`` rows, else joined.
    """
    known = labels.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).where(
        "key IS NOT NULL AND label IN (0, 1)"
    ).where(~held_out(F.col("key")))
    texts = docs.select(F.col(f"`{key}`").cast("string").alias("d_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = texts.where(~held_out(F.col("d_key")))
    few = labels.count() <= BROADCAST_LABELS
    joined = texts.join(F.broadcast(known) if few else known, F.col("d_key") == F.col("key")).select(
        F.md5(F.concat_ws("|", "key", F.md5(F.col("text").cast("binary"))).cast("binary")).alias("rank"), "label", "text",
    )
    counts = np.zeros((2, FEATURES))
    summed = joined.select("label", "text").mapInArrow(_counted, "feature long, bad long, good long").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    table = summed.toArrow()
    at = table["feature"].to_numpy()
    counts[0][at], counts[1][at] = table["bad"].to_numpy(), table["good"].to_numpy()
    smooth = counts + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())

    # The ranks say how far the sample reaches, so that only its texts are cut into features again.
    reach = joined.select("rank").orderBy("rank").limit(sample).agg(F.max("rank")).first()[0]
    listed = joined.where(F.col("rank") <= F.lit(reach)).mapInArrow(_listed, "rank string, label int, features array<int>")
    picked = listed.orderBy("rank", "label").limit(sample).toArrow().sort_by([("rank", "ascending"), ("label", "ascending")])
    good = picked["label"].to_numpy() == 1
    if not len(good):
        return Model(np.zeros(FEATURES), ratio**2, 0.0, 1.0, 0.0)
    rows = [np.asarray(f.as_py(), dtype=np.int64) for f in picked["features"]]
    values = [ratio[r] / max(float(np.sqrt((ratio[r] ** 2).sum())), 1e-12) for r in rows]
    solved = descend(rows, values, np.where(good, 1.0, -1.0), FEATURES)
    margins = np.array([solved[r] @ v for r, v in zip(rows, values)]) + solved[-1]
    slope, shift = _calibrated(margins, good)
    return Model(solved[:-1] * ratio, ratio**2, float(solved[-1]), slope, shift)


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "__text"):
            doc, feature = features(part.column("__text").cast(pa.string()))
            n = part.num_rows
            product = np.bincount(doc, model.weights[feature], minlength=n)
            length = np.sqrt(np.bincount(doc, model.scales[feature], minlength=n))
            margin = product / np.maximum(length, 1e-12) + model.bias
            score = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30)))
            names = [c for c in part.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(score)], names=[*names, "score"])


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without ``text``, with ``score`` (0 to 1, higher for label 1) and ``predicted``.

    Each row by itself and from its whole text alone: nothing is shuffled.  A null text is
    an empty one, which gets the score of a text without n-grams.  Repeated rows get equal
    scores, no rows give none; input columns named like an output are replaced.
    """
    own = without(docs, text, "score", "predicted", "__text")
    source = docs.select(*[F.col(f"`{c}`") for c in own.columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    found = source.mapInArrow(lambda b: _scored(b, model), own.schema.add("score", "double"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
