"""Cleaning, tokenising and labelling of text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.binding import bind

# The stop words of the keyword guard.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "of", "to", "in", "on", "for", "with", "by", "from",
    "what", "who", "when", "where", "why", "how", "is", "are", "was", "were", "be", "does",
    "do", "about",
]

# The refusal sentence and the prompt around question and context.
REFUSAL = "I don't know based on the MSR corpus."
PROMPT_HEAD = (
    "SYSTEM:\n"
    "Answer using ONLY the context chunks below.\n"
    "Rules:\n"
    '- If the answer is not in the context, reply exactly: "I don\'t know based on the MSR corpus."\n'
    "- Cite ONLY chunk indices from this set: [1.."
)
PROMPT_RULES = (
    "]. Do NOT invent other numbers.\n"
    "- Add citations [n] immediately after sentences that use chunk n.\n"
    "- Do NOT use prior knowledge.\n"
    "\n"
    "CONTEXT CHUNKS:\n"
)
PROMPT_QUESTION = "\n\nUSER QUESTION:\n"
PROMPT_TAIL = "\n\nASSISTANT:\n"

# The patterns whose matches must agree with the reference.
CONTROL = r"[\p{Cntrl}&&[^\t\n]]"
VOCABULARY_TOKEN = r"[a-zA-Z][a-zA-Z0-9_\-]+"
KEYWORD_TOKEN = r"[a-z0-9]+"

_UP_TO_SPACE = "".join(map(chr, range(0x21)))


def edge_trim(text: Column) -> Column:
    """Drop leading and trailing characters up to U+0020 (``trim`` alone drops only spaces)."""
    return F.btrim(text, F.lit(_UP_TO_SPACE))


def collapse(text: Column) -> Column:
    """Turn every run of whitespace into one space.

    The pattern passes over single spaces, most of the whitespace of a text, and looks at
    any other character once.
    """
    return F.regexp_replace(text, r"[ \t\n\x0B\f\r](?:(?<! )\s*+|\s++)", " ")


def sanitize(text: Column) -> Column:
    """Runs of control characters and whitespace become one space, edges trimmed.

    One pass does what replacing control characters by spaces first and
    collapsing whitespace afterwards would do: all whitespace but the space is
    a control character.
    """
    return F.trim(F.regexp_replace(text, r"\p{Cntrl}[ \p{Cntrl}]*| [ \p{Cntrl}]+", " "))


def chunk_normalize(text: Column) -> Column:
    """The lighter cleaning done before windows are cut: inner control characters stay."""
    return edge_trim(collapse(text))


def has_text(text: Column) -> Column:
    return F.length(text) > 0


def sanitizes_to_text(raw: Column) -> Column:
    """Whether anything is left of ``raw`` once sanitised, told from its first printing character."""
    return raw.rlike(r"[^ \p{Cntrl}]")


def long_enough(text: Column, min_chars: int = 120) -> Column:
    return F.length(text) >= min_chars


def odd_chars(text: Column) -> Column:
    """Number of characters above U+00FF."""
    return F.length(F.regexp_replace(text, r"[\x{0}-\x{FF}]+", ""))


def looks_corrupted(text: Column, share: float = 0.1) -> Column:
    """Empty, or more than ``share`` of the characters lie above U+00FF."""
    return (F.length(text) == 0) | (odd_chars(text) / F.length(text) > share)


def is_pdf(path: Column) -> Column:
    return F.lower(path).endswith(".pdf")


def decode_utf8(content: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(content.cast("string"))


def last_segment(uri: Column) -> Column:
    """Last path segment; ``uri`` itself when it consists of separators only."""
    bare = F.regexp_replace(uri, r"[/\\]+$", "")
    name = F.element_at(F.split(bare, r"[/\\]"), -1)
    return F.when(F.length(bare) > 0, name).otherwise(uri)


def title(text: Column, uri: Column) -> Column:
    """First line of the text, or the file name when that line is blank.

    Sanitised text has no line breaks, so there the title is the whole text;
    pass the raw text for a title of one line.
    """
    first = edge_trim(F.split(text, r"[\n\f]", 2)[0])
    return F.when(has_text(first), first).otherwise(last_segment(uri))


def language() -> Column:
    """Placeholder: every text is taken for English, whatever it holds."""
    return F.lit("en")


def keywords(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, stop words included."""
    return F.regexp_extract_all(F.lower(text), F.lit(KEYWORD_TOKEN), F.lit(0))


def without_stop_words(tokens: Column) -> Column:
    stop = F.array(*[F.lit(word) for word in STOP_WORDS])
    return F.filter(tokens, lambda token: ~F.array_contains(stop, token))


def vocabulary_tokens(text: Column) -> Column:
    """Tokens the vocabulary counts; the caller filters their length."""
    return F.regexp_extract_all(F.lower(text), F.lit(VOCABULARY_TOKEN), F.lit(0))


def analyzed_tokens(text: Column) -> Column:
    """Lower-case words of any script, the terms of the chunk postings."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """Distinct tokens of an array with their number, as ``token, freq`` structs.

    Equal tokens stand next to each other once sorted, so a count is the way to
    the start of the next run.
    """

    def runs(words: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(words)),
            lambda i: (i == 1) | (F.element_at(words, i) != F.get(words, i - 2)),
        )
        return bind(starts, lambda at: counted(words, at))

    def counted(words: Column, starts: Column) -> Column:
        end = F.size(words) + 1
        return F.transform(
            starts,
            lambda at, j: F.struct(
                F.element_at(words, at).alias("token"),
                (F.coalesce(F.get(starts, j + 1), end) - at).cast("long").alias("freq"),
            ),
        )

    none = F.array().cast("array<struct<token:string,freq:bigint>>")
    return bind(F.sort_array(tokens), lambda words: F.when(F.size(words) == 0, none).otherwise(runs(words)))


def hit_label(doc_id: Column, chunk_id: Column) -> Column:
    return F.concat_ws("#", doc_id, chunk_id.cast("string"))


def preview(text: Column, chars: int = 160, collapsed: bool = True) -> Column:
    return F.substring(collapse(text) if collapsed else text, 1, chars)


def prompt(question: Column, contexts: Column) -> Column:
    """Prompt for one question; ``contexts`` is the array of texts in rank order."""
    numbered = F.transform(
        contexts,
        lambda text, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), edge_trim(text)),
    )
    return F.concat(
        F.lit(PROMPT_HEAD), F.size(contexts).cast("string"), F.lit(PROMPT_RULES),
        F.array_join(numbered, "\n---\n"),
        F.lit(PROMPT_QUESTION), question, F.lit(PROMPT_TAIL),
    )


def drop_bad_citations(text: Column, max_n: Column) -> Column:
    """Delete every ``[n]`` with n outside 1..max_n, in one pass over the text.

    Numbers too long for an integer count as out of range.
    """
    allowed = F.array_join(F.sequence(F.lit(1), F.greatest(max_n, F.lit(1))).cast("array<string>"), "|")
    pattern = F.when(max_n < 1, F.lit(r"\[[0-9]+\]")).otherwise(
        F.concat(F.lit(r"\[(?!0*(?:"), allowed, F.lit(r")\])[0-9]+\]"))
    )
    return F.regexp_replace(text, pattern, F.lit(""))


def clean_answer(text: Column, refusal: str = REFUSAL) -> Column:
    """Drop lines that only repeat the refusal, collapse runs of blank lines, trim."""
    sentence = re.escape(refusal.rstrip("."))
    without = F.regexp_replace(text, rf"(?m)^\s*{sentence}\.?\s*$", "")
    return edge_trim(F.regexp_replace(without, r"(?m)^(\s*\n){2,}", "\n"))


def escape_lines(text: Column) -> Column:
    """One line: backslashes doubled, line feeds and returns as ``\\n`` and ``\\r``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(text: Column) -> Column:
    """What ``escape_lines`` was given."""
    parts = F.split(text, r"\\\\", -1)  # at doubled backslashes
    back = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(text.contains("\\"), F.array_join(back, "\\")).otherwise(text)


def pack_vector(vec: Column) -> Column:
    """Vector as numbers separated by one space."""
    return F.array_join(vec.cast("array<string>"), " ")


def unpack_vector(text: Column) -> Column:
    """Numbers separated by whitespace; what is no number is left out."""
    parsed = F.transform(F.split(text, r"\s+"), lambda part: part.try_cast("float"))
    return F.filter(parsed, lambda value: value.isNotNull())
