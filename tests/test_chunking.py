import random
import time

import pytest
from pyspark.sql import functions as F

from corpuscle.operators.chunking import chunk, chunk_by_paragraph


def windows(spark, text, max_chars, overlap):
    df = spark.createDataFrame([(text,)], "text string")
    return [r.text for r in chunk(df, "text", max_chars, overlap).orderBy("chunk_id").collect()]


def test_long_text(spark):
    text = ("Lorem ipsum " * 600).strip()
    got = windows(spark, text, 800, 200)
    assert len(got) == 12 and all(0 < len(c) <= 800 for c in got) and len(got[-1]) == 599
    assert got == [text[i : i + 800] for i in range(0, len(text), 600)]
    assert got[0] + "".join(c[200:] for c in got[1:]) == text


def test_short_empty_and_blank_text(spark):
    assert windows(spark, "abc def.", 1000, 200) == ["abc def."]
    assert windows(spark, "", 1000, 200) == [] and windows(spark, " \n\t ", 1000, 200) == []


def test_overlap_as_large_as_the_window_steps_by_one(spark):
    assert len(windows(spark, "abcdefghijk", 10, 10)) == 11


def test_last_window_inside_the_one_before_is_kept(spark):
    assert windows(spark, "abcdefghij" + "k", 10, 8) == ["abcdefghij", "cdefghijk", "efghijk", "ghijk", "ijk", "k"]


def test_window_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        windows(spark, "abc", 0, 0)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(7, "abc", "x")], "id int, text string, tag string")
    assert chunk(df).collect() == [(7, "x", 0, "abc")]


def packed(spark, text, max_len, min_len, separator=r"\n{2,}"):
    df = spark.createDataFrame([(text,)], "text string")
    return [r.text for r in chunk_by_paragraph(df, "text", max_len, min_len, separator).orderBy("chunk_id").collect()]


def test_paragraphs_are_packed_and_long_ones_cut(spark):
    assert packed(spark, "aa\n\nbbb\n\ncccccccccc\n\nd", 6, 1) == ["aa bbb", "cccccc", "cccc", "d"]
    assert packed(spark, "aa\n\nbbb\n\ncccccccccc\n\nd", 6, 3) == ["aa bbb", "cccccc", "cccc"]
    assert packed(spark, "", 6, 1) == [] and packed(spark, "\n\n \n\n", 6, 1) == []


def test_paragraph_packing_against_plain_loop(spark):
    rng = random.Random(5)
    texts = [
        "\n\n".join("".join(rng.choice("ab c") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 12)))
        for _ in range(60)
    ]

    def expected(text, limit=15, least=2):
        pieces, open_piece = [], ""
        for p in filter(None, (p.strip() for p in text.split("\n\n"))):
            if len(open_piece) + len(p) + 1 <= limit:
                open_piece = f"{open_piece}\n{p}" if open_piece else p
                continue
            pieces.append(open_piece)
            open_piece = p
            if len(p) > limit:
                pieces += [p[i : i + limit] for i in range(0, len(p), limit)]
                open_piece = ""
        pieces.append(open_piece)
        return [c for c in (" ".join(x.split()) for x in pieces) if len(c) >= least]

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = chunk_by_paragraph(df, "text", 15, 2).groupBy("id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "text"))), lambda r: r.text).alias("c")
    )
    got = {r.id: r.c for r in rows.collect()}
    assert [got.get(i, []) for i in range(len(texts))] == [expected(t) for t in texts]


def test_one_long_document_takes_time_in_proportion(spark):
    text = "word é " * 600_000  # the form that walked from the start for every window took minutes
    cleaned = text.strip()
    rows = spark.createDataFrame([(text,)], "text string")
    got = [r.text for r in chunk(rows, "text", 800, 160).orderBy("chunk_id").collect()]
    assert got == [cleaned[i : i + 800] for i in range(0, len(cleaned), 640)]


def test_many_short_and_one_long_paragraph(spark):
    text = "\n\n".join(f"paragraph {i}" for i in range(60_000)) + "\n\n" + "x" * 3_000_000
    got = packed(spark, text, 1200, 120)
    assert all(len(c) <= 1200 for c in got) and got[-2500:] == ["x" * 1200] * 2500
    assert " ".join(got[:-2500]) == " ".join(f"paragraph {i}" for i in range(60_000))


@pytest.mark.parametrize("size,overlap", [(7, 0), (7, 3), (7, 6), (7, 9), (1, 0), (3, 1)])
def test_windows_are_slices_at_each_stride(spark, size, overlap):
    rng = random.Random(size * 10 + overlap)
    for n in (1, 6, 7, 8, 20, 63):
        text = "".join(rng.choice("abé😀") for _ in range(n))
        step = max(size - overlap, 1)
        want = [text] if n <= size else [text[i : i + size] for i in range(0, n, step)]
        assert windows(spark, text, size, overlap) == want


def test_marks_in_paragraphs_count_as_characters(spark):
    assert packed(spark, "a\x1eb\n\n\x1e\n\ncd\n\nefghijklm\x1en\n\no", 6, 1) == ["a b cd", "efghij", "klm n", "o"]
    assert packed(spark, "a\x1eb\x1e\x1ec", 9, 1, "\x1e{2}") == ["a b c"]


def test_packing_takes_time_in_proportion(spark):
    spent = {}
    for size in (1, 1, 8):  # the first run warms up
        rows = spark.range(1).select(F.repeat(F.lit("one paragraph of some words\n\n" * 35), size * 1_000).alias("text"))
        start = time.monotonic()
        found = chunk_by_paragraph(rows).count()
        spent[size] = time.monotonic() - start
        assert found == -(-35_000 * size // 42)  # 42 of them and their joints take 1,175 code points, 43 take 1,203
    assert spent[8] < 16 * spent[1] + 2
