import hashlib
from collections import Counter

import pytest

from corpuscle.llm import sharding
from corpuscle.session import fresh_path


def bits(key):
    return "".join(f"{b:08b}" for b in hashlib.md5(str("" if key is None else key).encode()).digest()[:8])


def brute(sizes, limit):
    """Shard of each key by recursive splitting, for distinct keys."""
    out = {}

    def split(keys, depth):
        if sum(sizes[k] for k in keys) <= limit or len(keys) == 1:
            out.update(dict.fromkeys(keys, bits(keys[0])[:depth]))
        else:
            for bit in "01":
                if part := [k for k in keys if bits(k)[depth] == bit]:
                    split(part, depth + 1)

    split(list(sizes), 0)
    return out


@pytest.mark.parametrize("limit", [1, 40, 1000, 5000, 10**6])
def test_equals_brute_force(spark, limit):
    sizes = {i: (i * 37) % 97 for i in range(1500)} | {5000: 3000}
    docs = spark.createDataFrame([(k, "x" * n, "s") for k, n in sizes.items()], "doc_id long, text string, shard string").repartition(4)
    rows = sharding.assign_shards(docs, limit=limit).collect()
    assert {r["doc_id"]: r["shard"] for r in rows} == brute(sizes, limit) and len(rows) == len(sizes)
    assert all(r["depth"] == len(r["shard"]) and r["n_bytes"] == sizes[r["doc_id"]] for r in rows)


def test_rows_of_one_key_are_split_too(spark):
    docs = spark.createDataFrame([(7, "x" * 10)] * 500 + [(i, "y") for i in range(100, 600)] + [(None, "z" * 30)] * 40, "doc_id long, text string")
    rows = sharding.assign_shards(docs.repartition(3), limit=200).collect()
    assert len(rows) == 1040
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["n_bytes"]
    assert max(load.values()) <= 200
    names = sorted(load)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_null_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, "é")], "doc_id long, text string")
    assert sorted(tuple(r) for r in sharding.assign_shards(docs).collect()) == [(1, 0, "", 0), (2, 2, "", 0)]
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_shards_are_written_apart(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(60)], "doc_id long, text string")
    path = fresh_path(spark, "shards")
    sharding.write_shards(docs, path, limit=1000)
    back = spark.read.parquet(path)
    assert back.count() == 60 and all(r["count"] <= 10 for r in back.groupBy("shard").count().collect())


def test_written_rows_are_those_given_whatever_their_keys(spark):
    rows = [(7, f"x{i:09d}") for i in range(300)] + [(None, "z" * 30)] * 40 + [(i, "y") for i in range(100, 200)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = fresh_path(spark, "shards")
    sharding.write_shards(docs, path, limit=200)
    back = spark.read.schema("doc_id long, text string, shard string").parquet(path).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter(rows)
    load = Counter()
    for r in back:
        load[r["shard"]] += len(r["text"] or "")
    assert max(load.values()) <= 200


def test_no_python_in_the_plan(spark):
    plan = sharding.assign_shards(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
