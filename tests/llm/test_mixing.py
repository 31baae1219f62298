import brute
import pytest

from corpuscle.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def test_equals_brute_force(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", "x" * (i % 50)) for i in range(600)] + [(None, None, "abc"), (9999, None, None), (8888, "void", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [(r["doc_id"], r["replica"], r["order_key"]) for r in mixing.mix(docs).orderBy("order_key").collect()]
    assert got == brute.mixed(rows)


@pytest.mark.parametrize("mean", [0.0, 0.05, 1.0, 3.7, 16.0, 40.0, 700.0])
def test_means_and_variances(spark, mean):
    from pyspark.sql import functions as F

    counts = [r[0] for r in spark.range(4000).withColumn("d", mixing.distribution(F.lit(mean))).select(mixing.poisson_count(F.col("d"), F.col("id"))).collect()]
    average = sum(counts) / len(counts)
    spread = sum((c - average) ** 2 for c in counts) / len(counts)
    assert abs(average - mean) <= 5 * (mean / 4000) ** 0.5 + 1e-9
    assert abs(spread - mean) <= 0.2 * mean + 0.02


def test_sources_reach_their_weights(spark):
    rows = [(i, "big" if i % 10 else "small", "word " * 20) for i in range(5000)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights={"big": 0.5, "small": 0.5}, epochs=2.0)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["big"] - 5000) < 400 and abs(counts["small"] - 5000) < 400
    assert mixing.mix(spark.createDataFrame(rows, SCHEMA), weights={"big": 1.0}).where("source = 'small'").count() == 0


def test_same_rows_whatever_the_partitions(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "text " * (i % 9)) for i in range(300)], SCHEMA)
    one, other = (mixing.mix(d).orderBy("order_key").collect() for d in (docs.repartition(7), docs.coalesce(1)))
    assert one == other
    shuffled = [r["order_key"] for r in mixing.mix(docs).collect()]
    assert sorted(shuffled) == [r["order_key"] for r in one]


def test_repeats_clashing_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a", "hello", "r", 1)] * 3, SCHEMA + ", replica string, order_key int")
    rows = mixing.mix(docs, epochs=3.0).collect()
    assert {r["doc_id"] for r in rows} == {1} and 0 in {r["replica"] for r in rows}
    assert len({r["order_key"] for r in rows}) == len(rows)
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["text {}", "text"])
def test_rows_of_one_key_are_drawn_one_by_one(spark, text):
    """A third of all rows has one key, or is one row over and over: they reach their share and no task holds them in lumps."""
    rows = [(7 if i % 3 else None, "hot", text.format(i % 10_000)) for i in range(2_000)] + [(i, "rest", f"text {i}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs, weights={"hot": 0.5, "rest": 0.5}, epochs=3.0)
    per_row = (len("".join(t for _, _, t in rows)) * 1.5) / len("".join(t for _, s, t in rows if s == "hot"))
    got = mixed.where("source = 'hot'").collect()
    assert abs(len(got) - 2_000 * per_row) <= 5 * (2_000 * per_row) ** 0.5
    assert len({r["order_key"] for r in got}) == len(got)
    assert sorted(r["order_key"] for r in mixing.mix(docs).collect()) == [k for _, _, k in brute.mixed(rows)]
