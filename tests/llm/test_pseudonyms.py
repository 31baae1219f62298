import random
import re

import brute
import pytest

from corpuscle.llm import pseudonyms

KEY = "test key"


def card(draw, size=16):
    body = "".join(draw.choices("0123456789", k=size - 1))
    return body + str(brute.luhn(body))


def values():
    draw = random.Random(2)
    num = lambda n: "".join(draw.choices("0123456789", k=n))
    out = [("card", card(draw, n)) for n in (13, 15, 16, 16, 16, 19) for _ in range(4)]
    out += [("card", " ".join(re.findall("....", card(draw)))), ("card", "-".join(re.findall("....", card(draw))))]
    out += [("phone", f"+1 ({num(3)}) 555-{num(4)}") for _ in range(6)] + [("phone", "+49 30 1234567"), ("phone", "(212) 555-0100"), ("phone", "212-555-0100")]
    out += [("ipv4", ".".join(str(draw.randint(0, 255)) for _ in range(4))) for _ in range(8)]
    out += [("iban", v) for v in ("DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "ES9121000418450200051332",
                                  "NO9386011117947", "MT84MALT011000012345MTLCAST001S")]
    out += [("ssn", s) for s in ("001-01-0001", "899-99-9999", "665-12-3456", "667-12-3456", "123-45-6789")]
    out += [("date", d) for d in ("1700-01-01", "2099-12-31", "2024-02-29", "2024/03/01", "29.02.2000", "12/31/1999", "1969-07-20")]
    return out


def rewritten(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r["text"], r["n_pii"]) for r in pseudonyms.pseudonymise(docs, KEY).orderBy("doc_id").collect()]


def test_values_are_permuted_within_their_format(spark):
    found = values()
    texts = [f"See {v} there." for _, v in found]
    for (kind, value), (text, n) in zip(found, rewritten(spark, texts)):
        fresh = re.fullmatch(r"See (.*) there\.", text)[1]
        assert fresh == brute.pseudonym(kind, value, KEY), (kind, value)
        assert n == (fresh != value)
        if kind not in ("ipv4",):
            assert re.sub(r"\d", "0", fresh) == re.sub(r"\d", "0", value)
        assert brute.pseudonym(kind, fresh, KEY, back=True) == value
        if kind == "card":
            digits = re.sub(r"\D", "", fresh)
            assert brute.luhn(digits[:-1]) == int(digits[-1])
        if kind == "iban":
            assert brute.mod97(fresh.replace(" ", "")[4:] + fresh[:4]) == 1
        if kind == "ssn":
            assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", fresh)


@pytest.mark.parametrize("text", [
    None, "", "no data here", "1234567812345678", "version 2.0 and 3.14", "2023-02-30", "1650-01-01", "000-12-3456", "256.1.1.1",
    "call 555", "123456", "a @ b", "@home", "deadbeefdeadbeef", "1.2.3.4.5", "DE88370400440532013000", "AB12 CDEF GHIJ 1", "x" * 50_000, "9" * 5000, "." * 5000 + "@", "a" * 50_000 + "@",
])
def test_what_is_not_valid_stays(spark, text):
    assert rewritten(spark, [text]) == [(text, 0)]


def test_equal_values_stay_linked_and_nothing_is_left(spark):
    draw = random.Random(6)
    number, mail = card(draw), "Und.34@mail7.example.com"
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f"{number} {number}$$$", f"a,{number}!! 1.2.3.4 {number}", f"été.{mail}, {mail.upper()}.\n{mail}", f'token = "{secret}" and TOKEN: {secret.upper()}',
             f"{number} {card(draw)}", "+1 (826) 555-4081 190.137.223.204 du"]
    out = rewritten(spark, texts)
    fresh = brute.pseudonym("card", number, KEY)
    assert out[0] == (f"{fresh} {fresh}$$$", 2) and out[1][0].count(fresh) == 2 and out[1][1] == 3
    assert out[2][1] == 3 and out[2][0].endswith(", " + ".\n".join([brute.pseudonym("email", mail, KEY)] * 2))
    assert out[3] == (f'token = "{brute.pseudonym("secret", secret, KEY)}" and TOKEN: {brute.pseudonym("secret", secret.upper(), KEY)}', 2)
    assert out[4][1] == 2 and out[5][1] == 2
    for text, _ in out:
        assert not any(v in text.lower() for v in (number, mail.lower(), secret, "1.2.3.4", "555-4081", "190.137.223.204"))


def test_no_two_values_share_a_pseudonym():
    days = [brute.feistel(n // 773, n % 773, 189, 773, KEY, "date") for n in range(146097)]
    assert len(set(days)) == 146097
    assert sorted(brute.digits_permuted(f"{n:03d}", KEY, "card") for n in range(1000)) == [f"{n:03d}" for n in range(1000)]


def test_whole_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["text"], r["n_pii"]) for r in pseudonyms.pseudonymise(docs, KEY).collect()}
    want = {r["doc_id"]: brute.pseudonymised(r["text"], KEY) for r in docs.collect()}
    assert got == want and sum(n for _, n in want.values()) > 10


def test_columns_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "at 1.2.3.4", 7, "k")] * 2, "doc_id long, text string, n_chars long, N_PII string")
    rows = pseudonyms.pseudonymise(docs, KEY).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["n_pii"] == 1
    whole = pseudonyms.pseudonymised_documents(docs, KEY)
    assert whole.columns == docs.columns and whole.first()["n_chars"] == len(whole.first()["text"])
    assert pseudonyms.pseudonymise(docs.limit(0), KEY).count() == 0


@pytest.mark.parametrize("value, kept", [
    ("+33 1 42 68 53 00", "+33"), ("+7 495 123-45-67", "+7"), ("+61 2 9876 5432", "+61"), ("+353 1 234 5678", "+353"),
    ("+44 (0)20 7946 0958", "+44 (0)"), ("+49 (30) 1234567", "+49"), ("555 123 4567", ""), ("(555) 123 4567", ""), ("01 42 68 53 00", ""),
    ("020 7946 0958", ""), ("(030) 1234567", ""), ("91 234 56 78", ""),
])
def test_telephone_numbers_of_other_countries(spark, value, kept):
    text, n = rewritten(spark, [f"See {value}, 2 of them."])[0]
    fresh = re.fullmatch(r"See (.*), 2 of them\.", text)[1]
    assert n == 1 and fresh.startswith(kept) and re.sub(r"\d", "0", fresh) == re.sub(r"\d", "0", value)
    digits = brute.digits_permuted(re.sub(r"\D", "", value[len(kept):]), KEY, "phone")
    assert fresh == kept + brute.fill(value[len(kept):], digits)


def test_days_in_other_forms(spark):
    moved = lambda y, m, d: brute.pseudonym("date", f"{y:04d}-{m:02d}-{d:02d}", KEY)
    y, m, d = moved(1990, 2, 1).split("-")
    a, b, c = moved(1990, 12, 25).split("-")
    p, q, r = moved(1990, 3, 4).split("-")
    got = [t for t, _ in rewritten(spark, ["1.2.1990", "25-12-1990", "3/4/1990", "1990-3-4", "31/02/1990", "1.2.1990.5", "99-99-1990"])]
    assert got == [f"{int(d)}.{int(m)}.{y}", f"{c}-{b}-{a}", f"{int(q)}/{int(r)}/{p}", f"{p}-{int(q)}-{int(r)}", "31/02/1990", "1.2.1990.5", "99-99-1990"]


def test_days_read_with_day_and_month_exchanged_keep_apart(spark):
    values = [f"{d}/{m:02d}/{y}" for y in (1990, 2000) for m in range(1, 13) for d in range(13, 29)]
    fresh = [t for t, _ in rewritten(spark, values)]
    assert len(set(fresh)) == len(values) and not set(fresh) & set(values[:1])
    assert all(re.fullmatch(r"(1[3-9]|2\d|3[01])/(0[1-9]|1[0-2])/\d{4}", t) for t in fresh)


@pytest.mark.parametrize("text", ["3.01 42 68 53 00 0", "1 234 567 890", "0.123456789", "10-20-30", "0123 4567 8901 2345"])
def test_other_numbers_stay(spark, text):
    assert rewritten(spark, [text]) == [(text, 0)]


def test_long_accounts_are_permuted_whole(spark):
    values = ["ES9121000418450200051332", "FR1420041010050500013M02606", "PL61109010140000071219812874", "DE89370400440532013000"]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    got = [r["text"] for r in pseudonyms.pseudonymise(docs, KEY, whole_iban=True).orderBy("doc_id").collect()]
    for value, fresh in zip(values, got):
        assert brute.mod97(fresh[4:] + fresh[:4]) == 1 and re.sub(r"\d", "0", fresh) == re.sub(r"\d", "0", value)
        digits = re.sub(r"\D", "", value[4:])
        cut = max(len(digits) - 18, 0)
        once = digits[:cut] + brute.digits_permuted(digits[cut:], KEY, "iban")
        assert re.sub(r"\D", "", fresh[4:]) == (brute.digits_permuted(once[:18], KEY, "iban2") + once[18:] if cut else once)
