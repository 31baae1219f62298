import hashlib

import numpy as np
from pyspark.sql import functions as F

from corpuscle.operators import embed as embed_module
from corpuscle.operators.embed import embed_column, hashing_embedder


def test_hashing_embedder_follows_its_definition():
    embed = hashing_embedder(16)()
    want = np.zeros(16)
    for word in ["bug", "bug", "fix", "42"]:
        digest = hashlib.md5(word.encode()).hexdigest()
        want[int(digest[:8], 16) % 16] += 1 if int(digest[8], 16) % 2 == 0 else -1
    got = embed(["Bug, bug: FIX 42!", "", "é"])
    assert got[0].tolist() == want.tolist() and not got[1:].any()


def sizes_model(fail=(), short=False, empty=()):
    """Vector = [length]; fails on some texts, or returns too few vectors for a group."""

    def build():
        def embed(texts):
            if any(t in fail for t in texts):
                raise RuntimeError("no")
            found = [[] if t in empty else [float(len(t))] for t in texts]
            return found[:-1] if short and len(texts) > 1 else found

        return embed

    return build


def run(spark, model, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = embed_column(df, model, pause=0.0, **options).orderBy("i").collect()
    return [r.vec for r in rows], [r.embed_error for r in rows]


def test_results_stay_with_their_rows(spark):
    texts = ["x" * n for n in range(1, 40)]
    vectors, errors = run(spark, sizes_model(), texts, batch=7)
    assert vectors == [[float(n)] for n in range(1, 40)] and not any(errors)


def test_wrong_count_falls_back_to_single_texts(spark):
    vectors, errors = run(spark, sizes_model(short=True), ["a", "bb", "ccc"])
    assert vectors == [[1.0], [2.0], [3.0]] and not any(errors)


def test_failed_and_empty_texts_get_null_and_a_reason(spark):
    vectors, errors = run(spark, sizes_model(fail=("bad",), empty=("none",)), ["a", "bad", "none", None, "bb"])
    assert vectors == [[1.0], None, None, None, [2.0]]
    assert errors == [None, "RuntimeError: no", "no vector returned", "null text", None]


def test_a_call_is_repeated_before_it_counts_as_failed(spark):
    def build():
        calls = []

        def embed(texts):
            calls.append(1)
            if len(calls) < 3:
                raise RuntimeError("busy")
            return [[float(len(calls))] for _ in texts]

        return embed

    vectors, _ = run(spark, build, ["a", "b"], retries=2)
    assert vectors == [[3.0], [3.0]]


def test_default_model_dimension(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    assert embed_column(df).select(F.size("vec")).first()[0] == 64


def test_long_texts_are_embedded_in_portions(spark):
    def lengths():
        return lambda texts: [[float(len(texts)), float(len(t))] for t in texts]

    docs = spark.range(100).coalesce(1).select("id", F.repeat(F.lit("x"), (F.col("id") * 4000).cast("int")).alias("text"))
    rows = embed_column(docs, lengths, batch=1000).collect()
    assert [r["vec"][1] for r in rows] == [4000.0 * r["id"] for r in rows] and len(rows) == 100
    rows = embed_column(docs, lengths, batch=10).collect()
    assert {r["vec"][0] for r in rows} == {10.0}


def test_known_tokens_are_bounded():
    assert embed_module.KNOWN_TOKENS <= 100_000
