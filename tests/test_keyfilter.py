import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscle.operators import keyfilter
from corpuscle.operators.upsert import VERSION_KEY, upsert

KIND = "docId string, contentHash string, text string"


def rows(spark, docs):
    return spark.createDataFrame([(f"d{i:05}", f"h{v}", "t" * 50) for i, v in docs], KIND)


def test_filters_lose_no_key():
    draw = np.random.default_rng(1)
    keys, others = draw.integers(-2**63, 2**63, 5000), draw.integers(-2**63, 2**63, 5000)
    raw = keyfilter.bloom(keys)
    assert keyfilter.may_hold(raw, keys).all() and keyfilter.may_hold(raw, others).mean() < 0.01
    assert len(raw) <= 8 + 5000 * keyfilter.BITS // 8


def test_one_changed_document_opens_few_of_many_files(spark, tmp_path):
    path = str(tmp_path / "docs")
    order = list(range(6400))
    random.Random(2).shuffle(order)
    rows(spark, [(i, 1) for i in order]).repartition(64, "docId").write.parquet(path)
    assert keyfilter.add_filters(spark, path, VERSION_KEY) == len(keyfilter.files_of(spark, path)) >= 60
    same, changed = rows(spark, [(77, 1)]), rows(spark, [(77, 2)])
    assert 1 <= len(keyfilter.files_to_open(same, path, VERSION_KEY)) <= 4
    assert len(keyfilter.files_to_open(changed, path, VERSION_KEY)) <= 3
    upsert(same, path)
    assert spark.read.parquet(path).count() == 6400
    upsert(changed.union(same), path)
    upsert(changed, path)
    table = spark.read.parquet(path)
    assert table.count() == 6401 and table.where("docId = 'd00077'").count() == 2
    assert keyfilter.add_filters(spark, path, VERSION_KEY) == 0


def test_ranges_rule_out_files_of_a_sorted_table(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows(spark, [(i, 1) for i in range(400)]).repartitionByRange(8, "docId").write.parquet(path)
    keyfilter.add_filters(spark, path, VERSION_KEY)
    filters = keyfilter.key_filters(spark, path)
    met = filters.where((F.col("low") <= "d00005") & (F.col("high") >= "d00005"))
    assert met.count() == 1 and len(keyfilter.files_to_open(rows(spark, [(5, 1)]), path, VERSION_KEY)) == 1


@pytest.mark.parametrize("most", [1, 1_000_000])
def test_files_without_filter_and_many_or_null_keys(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(keyfilter, "MOST_KEYS", most)
    path = str(tmp_path / "docs")
    upsert(rows(spark, [(1, 1), (2, 1)]), path)
    rows(spark, [(3, 1)]).write.mode("append").parquet(path)  # by a writer that left no filter
    nulls = spark.createDataFrame([(None, "h1", "t"), ("d00009", None, "t")], KIND)
    for _ in range(2):
        upsert(rows(spark, [(1, 1), (3, 1), (4, 1)]).union(nulls), path)
    # A null key never matches, so its rows are added each time.
    assert sorted(r["docId"] or "" for r in spark.read.parquet(path).collect()) == ["", "", "d00001", "d00002", "d00003", "d00004", "d00009", "d00009"]
