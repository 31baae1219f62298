"""Plain Python versions of the operators, row by row, for small fixtures."""

import hashlib
import math
import re
from collections import Counter
from datetime import date, timedelta

import xxhash

from corpuscle.llm import licenses, mixing, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# line rules

def line_fails(line):
    words = len(WORD.findall(line))
    if not words:
        return False
    ended = re.search(r"[.!?:;,…\"'”’»)\]][\x20\x09-\x0D]*\Z", line)
    shouts = len(re.findall(rules.SHOUT, line))
    separators = len(re.findall(rules.SEPARATOR, line))
    stock = words <= rules.BOILERPLATE_LINE and re.search(rules.BOILERPLATE, line)
    return bool((words < rules.SHORT_LINE and not ended) or 10 * shouts >= 3 * words or (separators >= 3 and 4 * separators >= words) or stock)


def judged(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = text.split("\n")
    used = [x for x in lines if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    lost = sum(len(WORD.findall(x)) for x in lines if line_fails(x))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(used) - len(set(used)), len(covered),
            failed, not failed and lost <= 0.5 * len(words), "\n".join(x for x in lines if not line_fails(x)))


# licences

def license_row(text):
    words = ALNUM.findall(lowered(text))
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    best, labels = 0.0, set(base)
    for label, notice, marks in licenses.TEMPLATES:
        want, size = set(licenses.words_of(notice)), licenses.size_of(notice)
        for at in range(0, max(len(words) - size, 1), size):
            run = words[at:at + 2 * size]
            said = any(f" {mark} " in f" {' '.join(run)} " for mark in marks)
            if said and len(set(run) & want) >= math.ceil(licenses.THRESHOLD * len(want) - 1e-9):
                labels.add(label)
                best = max(best, len(set(run) & want) / len(want))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), max(best, 1.0 if places else 0.0))


# SimHash

def fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    digests = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def components(nodes, linked):
    """Smallest node reached from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in ordered}


# pseudonyms

def shingle_set(text, width=5):
    words = WORD.findall(lowered(text))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def smallest_ids(texts, similarity=0.8):
    """The smallest id of each group of texts linked by the similarity of their shingle sets, all pairs compared."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    near = lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9
    return sorted(set(components(list(sets), near).values()))


def _sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def feistel(left, right, a, b, key, kind, back=False):
    turns = range(10)
    for turn in reversed(turns) if back else turns:
        draw = lambda v, m: int(_sha(key, kind, a, b, turn, v)[:15], 16) % m  # noqa: B023, E731
        sign = -1 if back else 1
        if turn % 2 == 0:
            left = (left + sign * draw(right, a)) % a
        else:
            right = (right + sign * draw(left, b)) % b
    return left, right


def digits_permuted(s, key, kind, back=False):
    half = len(s) // 2
    a, b = feistel(int(s[:half]), int(s[half:]), 10**half, 10 ** (len(s) - half), key, kind, back)
    return f"{a:0{half}d}{b:0{len(s) - half}d}"


def luhn(body):
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return (10 - total % 10) % 10


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def fill(layout, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


def pseudonym(kind, value, key, back=False):
    if kind == "card":
        d = re.sub(r"\D", "", value)
        if luhn(d[:-1]) != int(d[-1]):
            return value
        body = digits_permuted(d[:-1], key, "card", back)
        return fill(value, body + str(luhn(body)))
    if kind == "phone":
        code = 2 if value.startswith("+1") else 3 if value.startswith("+") else 0
        rest = value[code:]
        return value[:code] + fill(rest, digits_permuted(re.sub(r"\D", "", rest), key, "phone", back))
    if kind == "iban":
        whole = value.replace(" ", "")
        digits = re.sub(r"\D", "", whole[4:])
        if mod97(whole[4:] + whole[:4]) != 1 or len(digits) < 2:
            return value
        kept = max(len(digits) - 18, 0)
        digits = digits[:kept] + digits_permuted(digits[kept:], key, "iban", back)
        check = f"{98 - mod97(fill(whole[4:], digits) + whole[:2] + '00'):02d}"
        return fill(value, check + digits)
    if kind == "ipv4":
        o = list(map(int, value.split(".")))
        x, y = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4", back)
        return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    if kind == "ssn":
        a, g, s = int(value[:3]), int(value[4:6]), int(value[7:])
        x, y = feistel((a - (2 if a > 666 else 1)) * 99 + g - 1, s - 1, 898 * 99, 9999, key, "ssn", back)
        area = x // 99 + 1
        return f"{area + (area >= 666):03d}-{x % 99 + 1:02d}-{y + 1:04d}"
    if kind == "date":
        form = "%Y-%m-%d" if value[4:5] == "-" else "%Y/%m/%d" if value[4:5] == "/" else "%d.%m.%Y" if "." in value else "%m/%d/%Y"
        n = {k: int(v) for k, v in zip(re.findall("[Ymd]", form), re.findall(r"\d+", value))}
        try:
            day = (date(n["Y"], n["m"], n["d"]) - date(1700, 1, 1)).days
        except ValueError:
            return value
        if not 0 <= day < 146097:
            return value
        x, y = feistel(day // 773, day % 773, 189, 773, key, "date", back)
        return (date(1700, 1, 1) + timedelta(x * 773 + y)).strftime(form)
    if kind == "email":
        return _sha(f"{key}|email", value.lower())[:20].translate(str.maketrans("0123456789abcdef", "abcdefghijklmnop")) + "@pseudonym.invalid"
    if kind == "secret":
        text = (_sha(f"{key}|secret", value) + _sha(f"{key}|secret2", value))[:len(value)]
        return text if value == value.lower() else text.upper()
    raise ValueError(kind)


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)"
FOUND = re.compile(
    r"(?P<lead>(?i:token|secret|key|password)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<secret>[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?P<iban>[A-Z]{2}\d\d(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4})(?: (?=[A-Z]{0,3}\d)[0-9A-Z]{4}){1,6}(?: \d{1,3})?))(?![0-9A-Za-z])"
    rf"|(?<![0-9.])(?P<ipv4>(?:{_OCTET}\.){{3}}{_OCTET})(?!\.?[0-9])"
    r"|(?<![0-9])(?P<date>\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![0-9])"
    r"|(?<![0-9-])(?P<ssn>(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4})(?![0-9-])"
    r"|(?<![0-9+])(?P<phone>\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\+[2-9]\d(?:[ .-]?\d{2,4}){2,4}"
    r"|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?![0-9])"
    r"|(?<![0-9])(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![0-9])", re.ASCII)
MAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def pseudonymised(text, key):
    """Text and number of changed places; for texts whose keys and values do not overlap."""
    if text is None:
        return None, 0
    changed = 0

    def mail(m):
        nonlocal changed
        changed += 1
        return pseudonym("email", m.group(), key)

    def number(m):
        nonlocal changed
        kind = next(k for k in ("secret", "iban", "ipv4", "date", "ssn", "phone", "card") if m.group(k))
        fresh = pseudonym(kind, m.group(kind), key)
        changed += fresh != m.group(kind)
        return (m.group("lead") or "") + fresh

    return FOUND.sub(number, MAIL.sub(mail, text)), changed


# mixing

def _md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def inverse_poisson(mean, u):
    p = below = math.exp(-mean)
    n = 0
    for k in range(1, mixing.TERMS + 1):
        n += below <= u
        p = p * mean / k
        below = below + p
    return n


def poisson(mean, key):
    parts = max(math.ceil(mean / mixing.PART), 1)
    return sum(inverse_poisson(mean / parts, int(_md5(mixing.SEED, key, i)[:13], 16) / 2**52) for i in range(1, parts + 1))


def mixed(rows, temperature=0.5, wholes=None):
    """(doc_id, replica, order_key) of every copy of rows (doc_id, source, text); ``wholes``: all columns of each row."""
    sizes, seen = Counter(), Counter()
    for _, source, text in rows:
        sizes[source] += len(text or "")
    total, scaled = sum(sizes.values()), sum(n**temperature for n in sizes.values())
    out = []
    for (doc, source, _), whole in zip(rows, wholes or rows):
        n = sizes[source]
        mean = n**temperature / scaled * total / n if n else 0.0
        digest = _md5(*["null" if v is None else hashlib.md5(str(v).encode()).hexdigest() for v in whole])
        ident = f"{digest}|{seen[digest]}"
        seen[digest] += 1
        out += [(doc, r, _md5(mixing.SEED, "order", ident, r)) for r in range(poisson(mean, ident))]
    return sorted(out, key=lambda r: r[2])
