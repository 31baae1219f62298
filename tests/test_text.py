import hashlib
import re

from pyspark.sql import functions as F

from corpuscle.functions import hashing as H
from corpuscle.functions import text as T


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def one_column(spark, rows, function):
    return values(spark, [(r,) for r in rows], "t string", function(F.col("t")))


AWKWARD = ["", "  ", "a", " a\x00b\tc\n\nd\x7f ", "a\x0bb\x0c\r\nc", "é  ü x", "\x01\x02", "x\x1f \x1fy", "tail\n"]


def test_sanitize_equals_two_step_definition(spark):
    def two_step(text):
        return re.sub(r"[ \t\n\x0b\f\r]+", " ", re.sub(r"[\x00-\x08\x0b-\x1f\x7f]", " ", text)).strip(" ")

    assert one_column(spark, AWKWARD, T.sanitize) == [two_step(t) for t in AWKWARD]
    assert one_column(spark, AWKWARD, T.sanitizes_to_text) == [two_step(t) != "" for t in AWKWARD]


def test_chunk_normalize_keeps_inner_control_characters(spark):
    def plain(text):
        return re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip("".join(map(chr, range(33))))

    assert one_column(spark, AWKWARD, T.chunk_normalize) == [plain(t) for t in AWKWARD]


def test_corrupted_share(spark):
    rows = ["", "abc", "abcdefghi→", "abcdefgh→→", "→"]
    assert one_column(spark, rows, T.looks_corrupted) == [True, False, False, True, True]


def test_length_and_extension_predicates(spark):
    assert one_column(spark, ["x" * 119, "x" * 120], T.long_enough) == [False, True]
    assert one_column(spark, ["a.pdf", "b/A.PDF", "pdf", "a.pdf.txt"], T.is_pdf) == [True, True, False, False]


def test_decode_replaces_malformed_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xe9 ol\xc3\xa9 \xff"),)], "b binary")
    assert df.select(T.decode_utf8(F.col("b"))).first()[0] == "caf� olé �"


def test_title_falls_back_to_file_name(spark):
    rows = [
        ("first line\nsecond", "a/b.txt"), ("", "a/b.txt"), ("\nsecond", "a\\c.txt"), ("  \r\nx", "dir/"), ("", "///"),
        ("one\ftwo", "x"),
    ]
    got = values(spark, rows, "t string, u string", T.title(F.col("t"), F.col("u")))
    assert got == ["first line", "b.txt", "c.txt", "dir", "///", "one"]


def test_keywords_and_stop_words(spark):
    rows = ["What does the RagMapper do?", "Ünïcode-42 x"]
    assert one_column(spark, rows, T.keywords) == [["what", "does", "the", "ragmapper", "do"], ["n", "code", "42", "x"]]
    assert one_column(spark, rows, lambda c: T.without_stop_words(T.keywords(c)))[0] == ["ragmapper"]


def test_vocabulary_tokens(spark):
    assert one_column(spark, ["A bug_fix-1 9lives x C3"], T.vocabulary_tokens) == [["bug_fix-1", "lives", "c3"]]


def test_citations_are_judged_in_one_pass(spark):
    rows = [
        ("a [1] b [9] c [12] e [2]", 3), ("[1[9]2] [12]", 3), ("[0] [00] [003] [] [x]", 3), ("[1] x", 0),
        ("[99999999999999999999] [10] [11]", 10),
    ]
    got = values(spark, rows, "t string, n int", T.drop_bad_citations(F.col("t"), F.col("n")))
    assert got == ["a [1] b  c  e [2]", "[12] ", "  [003] [] [x]", " x", " [10] "]


def test_answer_cleanup(spark):
    rows = [
        "Yes [1].\nI don't know based on the MSR corpus.\n", "I don't know based on the MSR corpus",
        "a\n\n\n\nb", "He said I don't know based on the MSR corpus. ok",
    ]
    assert one_column(spark, rows, T.clean_answer) == ["Yes [1].", "", "a\n\nb", rows[3]]


def test_term_counts(spark):
    got = one_column(spark, ["b a b c b a", "", "x"], lambda c: T.term_counts(T.keywords(c)))
    assert [[tuple(r) for r in row] for row in got] == [[("a", 2), ("b", 3), ("c", 1)], [], [("x", 1)]]


def test_prompt(spark):
    df = spark.sql("select 'why?' q, array(' one ', 'two\n') c")
    text = df.select(T.prompt(F.col("q"), F.col("c"))).first()[0]
    assert text == (
        "SYSTEM:\nAnswer using ONLY the context chunks below.\nRules:\n"
        '- If the answer is not in the context, reply exactly: "I don\'t know based on the MSR corpus."\n'
        "- Cite ONLY chunk indices from this set: [1..2]. Do NOT invent other numbers.\n"
        "- Add citations [n] immediately after sentences that use chunk n.\n- Do NOT use prior knowledge.\n\n"
        "CONTEXT CHUNKS:\n[1] one\n---\n[2] two\n\nUSER QUESTION:\nwhy?\n\nASSISTANT:\n"
    )


def test_preview_and_label(spark):
    assert one_column(spark, ["a \n b" + "c" * 200], T.preview)[0] == "a b" + "c" * 157
    got = values(spark, [("d", 3)], "d string, c int", T.hit_label(F.col("d"), F.col("c")))
    assert got == ["d#3"]


def test_vector_text_round_trip(spark):
    assert one_column(spark, ["0.5 x 1e3", "", " 1 2 "], T.unpack_vector) == [[0.5, 1000.0], [], [1.0, 2.0]]
    assert spark.sql("select array(cast(0.5 as float), cast(-2 as float)) v").select(T.pack_vector(F.col("v"))).first()[0] == "0.5 -2.0"


def test_string_hash_is_the_java_one(spark):
    def java(text):
        value = 0
        units = text.encode("utf-16-be")
        for i in range(0, len(units), 2):
            value = (value * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
        return value

    rows = ["", "hello", "é→", "🎉 party", "x" * 70]
    assert one_column(spark, rows, H.string_hash) == [java(t) for t in rows]
    assert java("hello") == 99162322
    assert one_column(spark, rows, lambda c: H.shard_of(c, 7)) == [(java(t) & 0x7FFFFFFF) % 7 for t in rows]


def test_chunk_key(spark):
    got = values(spark, [("f.txt", "body")], "f string, c string", H.chunk_key(F.col("f"), F.col("c")))
    assert got == ["f.txt#" + hashlib.sha256(b"body").hexdigest()[:12]]
