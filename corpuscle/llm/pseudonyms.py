"""Format-preserving pseudonyms for personal data in texts.

Numbers and dates that pass the checks of their kind are permuted by a keyed Feistel
network over exactly the values of that kind, so that a pseudonym is valid in the same
format, no two values share one, and equal values get equal pseudonyms in every
document.  Nothing is looked up or shuffled: the pseudonym is a function of the value
and the key.  Column expressions throughout; no Python on executors.

The network works on pairs (l, r) of Z_a x Z_b: in turn l += f(r) mod a and
r += f(l) mod b, with f taken from SHA-256 of key, kind, round and value, which is a
permutation for any a and b.

Kinds and their domains: payment cards (13 to 19 digits, Luhn check; all digits but the
last are permuted and the check digit is set anew), IBANs (remainder check; up to 18 digits
of the account are permuted and the check digits set anew), telephone numbers (the digits after
the country code), IPv4 addresses (2^32), social security numbers (all valid ones),
dates from 1700-01-01 to 2099-12-31 (all days of that 400-year cycle) as year, month, day or
with the year last, days and months of one or two digits, between '-', '.' or '/'.  Two kinds have no numeric domain: local part and
domain of an e-mail address become letters of a keyed digest at a reserved domain, and
hexadecimal secrets after a word such as ``token`` become a keyed digest of their length
and case; both link equal values too, but cannot be undone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import without

ROUNDS = 10
FIRST_DAY, DAYS = "1700-01-01", (189, 773)  # 189 * 773 days are 400 years
CYCLE = 146_097

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
SECRET = (
    r"(?<![0-9A-Za-z])(?<=(?i:token|secret|key|password)[\"']{0,1}\s{0,3}[=:]\s{0,3}[\"']{0,1})"
    r"(?:[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z])"
)
IPV4 = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?[0-9])"
DATE = (
    r"(?<![0-9])(?:(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])|(?<![0-9][./-])(?:"
    + "|".join(rf"[0-9]{{4}}{c}[0-9]{{1,2}}{c}[0-9]{{1,2}}|[0-9]{{1,2}}{c}[0-9]{{1,2}}{c}[0-9]{{4}}" for c in ("-", "/", r"\."))
    + r")(?![0-9]|[./-][0-9]))"
)
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
# Country codes are of one, two or three digits, and none begins another.
CALLING = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})(?:[ .-]?\(0\))?"
SPACED_CARD = r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
PHONE = (
    r"(?<![0-9+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    rf"|(?!\+1){CALLING}(?:[ .-]?\([0-9]{{1,4}}\))?(?:[ ./-]?[0-9]){{4,16}}"
    r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    rf"|(?<![0-9][.,])(?!{SPACED_CARD})(?=0[1-9][0-9]{{0,3}}[ ./-])0(?:[ ./-]?[0-9]){{8,11}}"
    r"|\(0[1-9][0-9]{0,3}\)(?:[ ./-]?[0-9]){5,9}"
    r"|(?<![0-9][.,])[6-9][0-9](?: [0-9]{3}|[0-9] [0-9]{2})(?: [0-9]{2}){2})(?![0-9])"
)
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
IBAN = (
    r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}"
    r"|(?: [0-9A-Z]{4})(?: (?=[A-Z]{0,3}[0-9])[0-9A-Z]{4}){1,6}(?: [0-9]{1,3})?)(?![0-9A-Za-z])"
)
NUMBER = rf"(?=[0-9+(a-fA-Z])(?:{SECRET}|{IBAN}|{IPV4}|{DATE}|{SSN}|{PHONE}|{CARD})"

Rewrite = Callable[[Column], Column]


def _let(value: Column, use: Rewrite) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _digest(key: str, kind: str, *values: Column) -> Column:
    parts = [p for v in values for p in (F.lit("|"), v.cast("string"))]
    return F.sha2(F.concat(F.lit(f"{key}|{kind}"), *parts), 256)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """The struct (l, r) that the pair in Z_a x Z_b is permuted to."""

    def drawn(turn: Column, value: Column, modulus: Column) -> Column:
        bits = F.conv(F.substring(_digest(key, kind, a, b, turn, value), 1, 15), 16, 10)
        return bits.cast("long") % modulus

    return F.aggregate(
        F.array(*[F.lit(i) for i in range(ROUNDS)]),
        F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")),
        lambda at, turn: F.struct(
            F.when(turn % 2 == 0, (at.l + drawn(turn, at.r, a)) % a).otherwise(at.l).alias("l"),
            F.when(turn % 2 == 1, (at.r + drawn(turn, at.l, b)) % b).otherwise(at.r).alias("r"),
        ),
    )


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits permuted among those of its length."""
    def use(s: Column) -> Column:
        size = F.char_length(s)
        half = F.floor(size / 2).cast("int")
        power = lambda n: F.pow(F.lit(10.0), n).cast("long")
        out = feistel(F.substr(s, F.lit(1), half), F.substr(s, half + 1), power(half), power(size - half), key, kind)
        return _let(out, lambda p: F.concat(F.lpad(p.l.cast("string"), half, F.lit("0")),
                                            F.lpad(p.r.cast("string"), size - half, F.lit("0"))))

    return _let(digits, use)


def _fill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced in turn."""
    before = lambda k: F.char_length(_digits(F.substr(layout, F.lit(1), k)))
    return F.array_join(F.transform(
        F.sequence(F.lit(1), F.char_length(layout)),
        lambda k: _let(F.substr(layout, k, F.lit(1)), lambda c: F.when(c.rlike("[0-9]"), F.substr(digits, before(k), F.lit(1))).otherwise(c)),
    ), "")


def _luhn_check(body: Column) -> Column:
    """Check digit of a number without its last digit."""
    size = F.char_length(body)
    def add(total: Column, k: Column) -> Column:
        digit = F.substr(body, k, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((size - k) % 2 == 0, doubled).otherwise(digit)

    return (10 - F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10) % 10


def _card(value: Column, key: str) -> Column:
    def use(digits: Column) -> Column:
        body = F.substr(digits, F.lit(1), F.char_length(digits) - 1)
        valid = F.substr(digits, F.char_length(digits)).cast("int") == _luhn_check(body)
        fresh = _let(_permuted_digits(body, key, "card"), lambda b: F.concat(b, _luhn_check(b).cast("string")))
        return F.when(valid, _let(fresh, lambda d: _fill(value, d))).otherwise(value)

    return _let(_digits(value), use)


def _mod97(text: Column) -> Column:
    """Remainder of a number written with letters for 10 to 35."""
    def add(rest: Column, k: Column) -> Column:
        value = F.conv(F.substr(text, k, F.lit(1)), 36, 10).cast("int")
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(text)), F.lit(0), add)


def _iban(value: Column, key: str, whole_iban: bool) -> Column:
    def use(whole: Column) -> Column:
        country, account = F.substr(whole, F.lit(1), F.lit(2)), F.substr(whole, F.lit(5))
        valid = _mod97(F.concat(account, F.substr(whole, F.lit(1), F.lit(4)))) == 1

        def moved(digits: Column) -> Column:
            kept = F.greatest(F.char_length(digits) - 18, F.lit(0))
            fresh = F.concat(F.substr(digits, F.lit(1), kept), _permuted_digits(F.substr(digits, kept + 1), key, "iban"))
            if whole_iban:  # the first 18 digits once more, which overlap with the last
                fresh = _let(fresh, lambda d: F.when(kept > 0, F.concat(
                    _permuted_digits(F.substr(d, F.lit(1), F.lit(18)), key, "iban2"), F.substr(d, F.lit(19)))).otherwise(d))
            return _let(fresh, lambda d: _let(
                F.lpad((98 - _mod97(F.concat(_fill(account, d), country, F.lit("00")))).cast("string"), 2, "0"),
                lambda check: _fill(value, F.concat(check, d)),
            ))

        digits = _digits(account)
        return F.when(valid & (F.char_length(digits) >= 2), _let(digits, moved)).otherwise(value)

    return _let(F.replace(value, F.lit(" "), F.lit("")), use)


def _phone(value: Column, key: str) -> Column:
    code = F.char_length(F.regexp_extract(value, f"^{CALLING}", 0))
    return _let(F.substr(value, code + 1), lambda rest: F.concat(
        F.substr(value, F.lit(1), code),
        _let(_permuted_digits(_digits(rest), key, "phone"), lambda d: _fill(rest, d)),
    ))


def _ipv4(value: Column, key: str) -> Column:
    octet = lambda parts, i: parts[i].cast("long")
    return _let(F.split(value, r"\."), lambda p: _let(
        feistel(octet(p, 0) * 256 + octet(p, 1), octet(p, 2) * 256 + octet(p, 3), _long(65536), _long(65536), key, "ipv4"),
        lambda x: F.concat_ws(".", *[c.cast("string") for half in (x.l, x.r) for c in (F.floor(half / 256), half % 256)]),
    ))


def _ssn(value: Column, key: str) -> Column:
    part = lambda at, n: F.substring(value, at, n).cast("long")
    area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)
    out = feistel(area * 99 + part(5, 2) - 1, part(8, 4) - 1, _long(898 * 99), _long(9999), key, "ssn")
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
    return _let(out, lambda x: _let(F.floor(x.l / 99) + 1, lambda a: F.concat_ws(
        "-", pad(a + F.when(a >= 666, 1).otherwise(0), 3), pad(x.l % 99 + 1, 2), pad(x.r + 1, 4))))


def _date(value: Column, key: str) -> Column:
    """Read as year-month-day, mm/dd/yyyy, dd.mm.yyyy or dd-mm-yyyy; if that is no day, with day and month exchanged.

    An exchanged reading has a day above 12.  It is moved among such days only, so
    that its pseudonym reads the same way and is no other day's.
    """
    year_first, slashed = value.rlike("^[0-9]{4}"), value.contains("/")
    mark = F.regexp_extract(value, "[./-]", 0)
    start = F.lit(FIRST_DAY).cast("date")

    def use(part: Column) -> Column:
        year, low, high = F.when(year_first, part[0]).otherwise(part[2]), part[1], F.when(year_first, part[2]).otherwise(part[0])
        number = lambda month, day: F.datediff(F.try_to_timestamp(
            F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date"), start).cast("long")
        usual = F.when(year_first | ~slashed, number(low, high)).otherwise(number(high, low))
        other = F.when(year_first, F.lit(None).cast("long")).when(slashed, number(low, high)).otherwise(number(high, low))
        date = lambda n: F.date_add(start, n.cast("int"))
        moved = lambda n: _let(feistel(
            F.floor(n / DAYS[1]), n % DAYS[1], _long(DAYS[0]), _long(DAYS[1]), key, "date"), lambda x: x.l * DAYS[1] + x.r)
        walked = lambda n: F.aggregate(
            F.sequence(F.lit(1), F.lit(100)), moved(n), lambda at, _: F.when(F.dayofmonth(date(at)) > 12, at).otherwise(moved(at)))
        short = (F.char_length(low) == 1) | (F.char_length(high) == 1)

        def written(fresh: Column, exchanged: Column) -> Column:
            piece = lambda long, brief: F.when(short, F.date_format(fresh, brief)).otherwise(F.date_format(fresh, long))
            y, m, d = F.date_format(fresh, "yyyy"), piece("MM", "M"), piece("dd", "d")
            month_first = slashed != exchanged
            return F.when(year_first, F.concat_ws(mark_text, y, m, d)).when(
                month_first, F.concat_ws(mark_text, m, d, y)).otherwise(F.concat_ws(mark_text, d, m, y))

        mark_text = "\x00"
        inside = lambda n: (n >= 0) & (n < CYCLE)
        text = lambda n, exchanged: _let(date(n), lambda d: F.replace(written(d, F.lit(exchanged)), F.lit(mark_text), mark))
        return _let(F.struct(usual.alias("usual"), other.alias("other")), lambda n: F.when(
            n.usual.isNotNull(), F.when(inside(n.usual), _let(moved(n.usual), lambda m: text(m, False))).otherwise(value)
        ).when(inside(n.other), _let(walked(n.other), lambda m: text(m, True))).otherwise(value))

    return _let(F.split(value, "[./-]"), use)


def _secret(value: Column, key: str) -> Column:
    drawn = F.concat(_digest(key, "secret", value), _digest(key, "secret2", value))
    text = F.substr(drawn, F.lit(1), F.char_length(value))
    return F.when(value == F.lower(value), text).otherwise(F.upper(text))


def _number(value: Column, key: str, whole_iban: bool) -> Column:
    """The pseudonym of what ``NUMBER`` has found; a value that fails its check stays."""
    return (
        F.when(value.rlike(rf"^{IBAN}$"), _iban(value, key, whole_iban))
        .when(value.rlike("[a-fA-F]"), _secret(value, key))
        .when(value.rlike(rf"^{IPV4}$"), _ipv4(value, key))
        .when(value.rlike(rf"^{DATE}$"), _date(value, key))
        .when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(value, key))
        .when(value.rlike(rf"^{PHONE}$"), _phone(value, key))
        .otherwise(_card(value, key))
    )


def _email(value: Column, key: str) -> Column:
    """Letters only, so that no number is found in a pseudonym."""
    letters = F.translate(F.substring(_digest(key, "email", F.lower(value)), 1, 20), "0123456789abcdef", "abcdefghijklmnop")
    return F.concat(letters, F.lit("@pseudonym.invalid"))


def _rewritten(text: Column, pattern: str, rewrite: Rewrite) -> Column:
    """Struct of the text with every match rewritten and the number of matches that changed."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    fresh = F.transform(found, lambda v: F.struct(v.alias("old"), rewrite(v).alias("new")))
    return _let(fresh, lambda pairs: F.struct(
        F.array_join(F.zip_with(
            F.split(text, pattern, -1), pairs, lambda part, pair: F.concat(part, F.coalesce(pair.new, F.lit("")))
        ), "").alias("text"),
        F.size(F.filter(pairs, lambda p: p.old != p.new)).cast("long").alias("n"),
    ))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", whole_iban: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_pii``, the number of replaced places.

    A null text stays null with ``n_pii`` 0; a text without any stays as it is, to the
    byte.  Values that look like a kind but fail its check (a number without a valid
    check digit, a day no calendar has) stay.  Rows are independent: repeated rows give
    equal results, an empty table none.  An input column ``n_pii`` is replaced.  With
    ``whole_iban`` all digits of accounts of more than 18 digits are permuted, else the last 18.
    """
    own = without(docs, "n_pii")
    body = F.col(f"`{text}`")
    same = lambda c: F.struct(c.alias("text"), F.lit(0).cast("long").alias("n"))
    names = [c for c in own.columns]
    first = own.withColumn("__e", F.when(F.contains(body, F.lit("@")), _rewritten(body, EMAIL, lambda v: _email(v, key))).otherwise(same(body)))
    mailed = F.col("__e.text")
    second = first.withColumn("__n", F.when(mailed.rlike("[0-9]"), _rewritten(mailed, NUMBER, lambda v: _number(v, key, whole_iban))).otherwise(same(mailed)))
    return second.select(
        *[F.col("__n.text").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in names],
        (F.col("__e.n") + F.col("__n.n")).alias("n_pii"),
    )


def pseudonymised_documents(docs: DataFrame, key: str, whole_iban: bool = False) -> DataFrame:
    """The same columns as ``docs``; ``n_chars`` follows the text."""
    done = pseudonymise(docs, key, whole_iban=whole_iban)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)
