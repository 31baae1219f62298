import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpuscle.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(words):
    """Neighbours by what is left when one code point is deleted."""
    rest = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rest[w[:i], w[i + 1:]].add(w)
            rest[w[:i], w[i + 1:]] |= {w[:i] + w[i + 1:]} & words.keys()
    near = defaultdict(set)
    for group in rest.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def answers(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = spelling.spelling_variants(docs)
    want = brute(counted((r["doc_id"], r["text"]) for r in docs.collect()))
    assert found.count() == len(want) > 1000 and answers(found) == want
    assert sum(w[0] is not None for w in want.values()) >= 5


def words_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)


def test_dense_words(spark):
    draw = random.Random(1)
    words = {}
    for _ in range(1500):
        w = "".join(draw.choice("abà") for _ in range(draw.randint(7, 9)))
        words[w] = draw.choice([2, 2, 3, 25, 400, 5000])
    got = answers(spelling.variants(words_of(spark, words)))
    assert got == brute(words) and max(v[3] for v in got.values()) > 5


def test_long_words(spark):
    draw = random.Random(2)
    words = {}
    for size in (15, 33, 64, 65, 130, 257, 1000, 3000):
        w = "".join(draw.choice("abcdefghij") for _ in range(size))
        words[w] = 50
        for at in (0, 1, size // 2 - 1, size // 2, size // 2 + 1, size - 2, size - 1):
            words[w[:at] + w[at + 1:]] = 2
            words[w[:at] + "z" + w[at + 1:]] = 3
            words[w[:at] + "é" + w[at:]] = 4
    words["a" * 40], words["a" * 41], words["a" * 43] = 900, 80, 2
    assert answers(spelling.variants(words_of(spark, words))) == brute(words)


def test_forms_are_followed_to_the_last(spark):
    words = {"abcdefgh"[:7] + "x" * i: 2 * 10**(8 - i) for i in range(8)}
    got = answers(spelling.variants(words_of(spark, words)))
    assert got == brute(words) and {v[1] for v in got.values()} == {"abcdefg"}


def test_equal_counts_take_the_first_in_code_points(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaaaé": 20, "aaaaaaz": 20, "baaaaaa": 19}
    got = answers(spelling.variants(words_of(spark, words)))
    assert got["aaaaaaa"] == ("aaaaaab", "aaaaaab", 2, 4, 20) and got == brute(words)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "short words only")], [(None, "Ändërung ändërung")] * 3])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert answers(spelling.spelling_variants(docs)) == brute(counted(rows))


def test_runs_and_deletions(spark):
    draw = random.Random(4)
    rows = [(i, " ".join("".join(draw.choice("abc×À") for _ in range(draw.randint(6, 8))) + draw.choice(["", "1", "-x", "Ā"]) for _ in range(300))) for i in range(40)]
    rows.append((7, "Longword" * 30000 + " " + "longword" * 30000))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(spelling.word_counts(docs).selectExpr("word", "NULL AS form", "word AS root", "n", "0 AS n_near", "NULL AS form_n")) == {
        w: (None, w, n, 0, None) for w, n in counted(rows).items()}
