import zlib

import pytest
import zstandard

from corpuscle.llm import language

FOLDER = "/root/testdata/sf0.01"
KIND = "doc_id long, text string, lang string, score int, rank int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.learn(docs)


def brute(text, model):
    """Sizes by whole compressions with the dictionaries, cut by hand."""
    if not text or not any(c.isalpha() for c in text):
        return None
    out = {}
    raw = language.plain(text)
    for name, content in model.dictionaries.items():
        ready = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=ready, write_content_size=False, write_dict_id=False)
        out[name] = sum(len(one.compress(raw[i:i + 2048] + b" " * 64)) for i in range(0, len(raw), 2048))
    return out


def test_smallest_encoding_of_the_whole_text(docs, model):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.identify(docs, model).collect():
        sizes = brute(texts[r["doc_id"]], model)
        if sizes is None:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        low, second = sorted(sizes.values())[:2]
        # Encoders of another dictionary state may differ by a few bytes a piece.
        assert sizes[r["lang_pred"]] <= low * 1.02 + 2
        assert 0 < r["score"] <= 1 and r["rejected"] == (r["margin"] < language.MARGIN)


def test_held_out_accuracy(docs, model):
    rows = language.identify(docs.select("doc_id", "text", docs["lang"].alias("truth")), model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 200 and sum(r["lang_pred"] == r["truth"] for r in held) / len(held) >= 0.98
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang_pred"] == r["truth"] for r in sure) / len(sure) >= 0.99


def test_held_out_rows_teach_nothing(spark, docs):
    turned = docs.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'xx', text) AS text",
                             "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'xx', lang) AS lang")
    assert language.learn(turned) == language.learn(docs)


def test_dictionaries_are_bounded(docs, model):
    assert set(model.dictionaries) == {"en", "fr", "de", "es"}
    assert all(0 < len(d) <= language.DICTIONARY for d in model.dictionaries.values())
    small = language.learn(docs, texts=3, most=500)
    assert all(len(d) <= 500 for d in small.dictionaries.values())


def test_long_text_is_read_to_its_end(spark, model):
    english, french = ("The thing of ertion and ouon. " * 5, "Èmentelle ouaux de la eauelle. " * 40000)
    rows = spark.createDataFrame([(1, english + french, None, 1, 1), (2, english, None, 1, 1)], KIND)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(rows, model).collect()}
    assert got == {1: "fr", 2: "en"}


def test_odd_rows(spark, model):
    rows = [(1, None, "en", 1, 1), (2, "", "en", 1, 1), (3, "12 !! ½²", "en", 1, 1), (None, "the thing of", None, 1, 1), (4, "the", "", 1, 1),
            (4, "the", "", 1, 1), (5, "न", None, 1, 1)]
    table = spark.createDataFrame(rows, KIND)
    got = language.identify(table, model).collect()
    assert len(got) == 7 and [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and all(r["rank"] == 1 for r in got)
    assert got[4] == got[5] and got[6]["lang_pred"] in model.dictionaries
    assert language.learn(table.limit(0)).dictionaries == {} and language.learn(table.where("text IS NULL")).dictionaries == {}
    assert {r["lang_pred"] for r in language.identify(table, language.Languages({})).collect()} == {"und"}
    one = language.identify(table, language.Languages({"en": b"the thing"})).where("doc_id = 4").first()
    assert (one["lang_pred"], one["score"], one["rejected"]) == ("en", 1.0, False)
    assert language.identify(table.limit(0), model).count() == 0
