import random

import brute
import pytest

from corpuscle.llm import rules

PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here today. "
TEXTS = [
    None, "", " \n\t", "one", PROSE, "\n".join(f"Line {i} has a few words in it, and it ends." for i in range(20)),
    "\n".join(["Home | About | Contact | Help"] * 3 + [f"{i} " + PROSE for i in range(6)]),
    " ".join(f"w{i}***" for i in range(80)), "Same words here. " * 40, "\n".join(f"no end {i}" for i in range(60)),
    "Accept our cookie policy now.\n" + " ".join(f"word{i}" for i in range(60)) + ".", "a\x0bb\x0cc\x1fd e f " * 20,
    " ".join(f"x{i}" for i in range(70_000)) + ".", "é|ü|ß " * 30, "\r\n".join(f"Win {i} line with seven words here." for i in range(20)),
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    words = ["a", "b", "See", "the.", "|", "x***", "!!", "\n", "\n", "end.", "cookie", "policy", "é", "\t"]
    return TEXTS + [" ".join(draw.choices(words, k=draw.randint(0, 160))) for _ in range(300)]


def test_equals_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in rules.line_rules(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned_text")) == brute.judged(text), text


def test_pieces_of_a_batch_change_nothing(texts, monkeypatch):
    import pyarrow as pa

    from corpuscle.llm import common

    batch = pa.record_batch({"i": list(range(len(texts))), "t": [t or "" for t in texts]})
    for most in (1, 50, 1000, 10**9):
        parts = list(common.pieces(batch.slice(2), "t", most))
        assert sum(p.num_rows for p in parts) == len(texts) - 2
        assert [x for p in parts for x in p.column("t").to_pylist()] == batch.column("t").to_pylist()[2:]


def test_clashing_columns_repeats_and_no_rows(spark):
    long = " ".join(f"word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(1, long, "x", 9)] * 3, "doc_id long, text string, kept string, N_WORDS int")
    rows = rules.line_rules(docs).collect()
    assert [(r["n_words"], r["kept"]) for r in rows] == [(60, True)] * 3
    assert rules.line_rules(docs.limit(0)).count() == 0


def test_kept_documents_have_the_same_columns(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(1, "Home | a | b | c\n" + good, "en", 5), (2, "short", "en", 5), (3, None, None, None)],
                                 "doc_id long, text string, lang string, n_chars long")
    kept = rules.kept_documents(docs)
    assert kept.schema.names == docs.schema.names
    assert [tuple(r) for r in kept.collect()] == [(1, good, "en", len(good))]
