"""The pipeline against plain Python, stage by stage and as a whole."""

import zlib

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpuscle.llm.queries import PII_KEY, TOKENIZER

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs.collect()]
    for _, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, FOLDER), "test")
        found.append(docs.collect())
    return found


def test_rules_come_first(outputs):
    before, after = outputs[0], outputs[1]
    want = {r["doc_id"]: j[7] for r in before if (j := brute.judged(r["text"]))[6]}
    assert {r["doc_id"]: r["text"] for r in after} == want and 0 < len(want) < len(before)


def test_one_of_each_group_stays(outputs):
    before, after = outputs[1], outputs[2]
    assert sorted(r["doc_id"] for r in after) == brute.smallest_ids({r["doc_id"]: r["text"] for r in before})


def test_personal_data_goes(outputs):
    assert {r["doc_id"]: r["text"] for r in outputs[3]} == {r["doc_id"]: brute.pseudonymised(r["text"], PII_KEY)[0] for r in outputs[2]}


def test_sources_are_mixed(outputs):
    want = brute.mixed([(r["doc_id"], r["source"], r["text"]) for r in outputs[3]], wholes=[tuple(r) for r in outputs[3]])
    assert sorted(r["doc_id"] for r in outputs[4]) == sorted(d for d, _, _ in want)


def packed(rows, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = sorted({0, *range(len(ids) % 1024, len(ids), 1024)})
        want += [(doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)]))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


def test_pieces_are_packed(outputs):
    packed(outputs[5], [(r["doc_id"], r["text"]) for r in outputs[4]])


def test_columns_are_those_of_documents(outputs):
    for rows in outputs[:-1]:
        assert list(rows[0].asDict()) == list(outputs[0][0].asDict())
        assert rows is outputs[0] or all(r["n_chars"] == len(r["text"]) for r in rows)


def test_run_gives_the_rows_of_the_last_stage(spark, outputs):
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(key, outputs[5]))


def test_whole_run_equals_brute_force(outputs):
    kept = [(r, j[7]) for r in outputs[0] if (j := brute.judged(r["text"]))[6]]
    first = set(brute.smallest_ids({r["doc_id"]: t for r, t in kept}))
    new = [(r, brute.pseudonymised(t, PII_KEY)[0]) for r, t in kept if r["doc_id"] in first]
    rows = [(r["doc_id"], r["source"], t) for r, t in new]
    wholes = [tuple({**r.asDict(), "text": t, "n_chars": len(t)}.values()) for r, t in new]
    text = {doc: t for doc, _, t in rows}
    packed(outputs[5], [(doc, text[doc]) for doc, _, _ in brute.mixed(rows, wholes=wholes)])


def test_no_rows_and_odd_rows(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "a b c. " * 40, "en", None, 3), (None, "d e f. " * 40, None, "s", None)]):
        docs = spark.createDataFrame(rows, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(function(spark, docs, FOLDER), "odd")
        docs.collect()
