"""Line-first cleaning: rules per line, then a verdict per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import dense, joint, pieces, without

MIN_WORDS = 50
MAX_REPEATED = 0.5
MAX_LOST = 0.5
SHORT_LINE = 6
BOILERPLATE_LINE = 30

# RE2 patterns, the same in Arrow and in SQL.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
ENDED = r"[.!?:;,…\"'”’»)\]][\x20\x09-\x0D]*$"
SEPARATOR = r"[|»›•·>]"
SHOUT = r"!!|[*#$%&]{3}"
BOILERPLATE = (
    r"(?i)(cookie (policy|settings)|privacy policy|terms of (use|service)|all rights reserved|click here"
    r"|subscribe to|sign up (for|now)|log in to|enable javascript|lorem ipsum|share (this|on)|skip to content)"
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_lost")


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values of a list array and the row each one came from."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.repeat(np.arange(len(lists), dtype=np.int64), sizes)


def _numpy(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def failing_lines(lines: pa.Array, words: np.ndarray) -> np.ndarray:
    """Which lines break a rule; a line without a word never does.

    * punctuation: fewer than ``SHORT_LINE`` words and no closing mark, or shouting
      marks on three words of ten;
    * navigation: at least three separators, one for every four words;
    * boilerplate: a stock phrase in a line of at most ``BOILERPLATE_LINE`` words.
    """
    ended = _numpy(pc.match_substring_regex(lines, ENDED))
    shouts = _numpy(pc.count_substring_regex(lines, SHOUT)).astype(np.int64)
    separators = _numpy(pc.count_substring_regex(lines, SEPARATOR)).astype(np.int64)
    stock = np.zeros(len(lines), dtype=bool)
    few = np.flatnonzero((words > 0) & (words <= BOILERPLATE_LINE))
    stock[few] = _numpy(pc.match_substring_regex(lines.take(pa.array(few)), BOILERPLATE))
    punctuation = (words < SHORT_LINE) & ~ended | (10 * shouts >= 3 * words)
    navigation = (separators >= 3) & (4 * separators >= words)
    return (words > 0) & (punctuation | navigation | stock)


def measure(texts: pa.Array) -> dict[str, object]:
    """The counts of ``COUNTS`` per text, and the texts without their failing lines."""
    n = len(texts)
    words, doc = _flat(pc.ascii_split_whitespace(texts))
    real = _numpy(pc.greater(pc.binary_length(words), 0))
    words, doc = words.filter(pa.array(real)), doc[real]
    out: dict[str, object] = {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": np.bincount(doc, _numpy(pc.utf8_length(words)), minlength=n).astype(np.int64),
        "n_symbols": _numpy(pc.count_substring_regex(texts, SYMBOL)).astype(np.int64),
    }

    repeated = np.zeros(len(words), dtype=bool)
    if len(words) >= 3:
        code, size = dense(words)
        starts = np.flatnonzero(doc[:-2] == doc[2:])
        key, _ = dense(joint((doc[starts], n), *((code[starts + i], size) for i in range(3))))
        starts = starts[np.bincount(key)[key] > 1] if len(key) else starts
        for i in range(3):
            repeated[starts + i] = True
    out["n_repeat_words"] = np.bincount(doc[repeated], minlength=n)

    lines, owner = _flat(pc.split_pattern(texts, "\n"))
    line_words = _numpy(pc.count_substring_regex(lines, WORD)).astype(np.int64)
    used = line_words > 0
    code, size = dense(lines)
    distinct = np.unique(joint((owner[used], n), (code[used], size)), return_index=True)[1]
    out["n_dup_lines"] = np.bincount(owner[used], minlength=n) - np.bincount(owner[used][distinct], minlength=n)

    bad = failing_lines(lines, line_words)
    out["words_lost"] = np.bincount(owner[bad], line_words[bad], minlength=n).astype(np.int64)
    left = lines.filter(pa.array(~bad))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[~bad], minlength=n))]).astype(np.int32)
    out["cleaned"] = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), left), "\n")
    return out


def _measured(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, column):
            found = measure(piece.column(column).cast(pa.string()))
            names = [c for c in piece.schema.names if c != column]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), *(pa.array(found[c], pa.int64()) for c in COUNTS), found["cleaned"]],
                names=[*names, *COUNTS, "cleaned_text"],
            )


def line_rules(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` without ``text``, with the counts, ``cleaned_text``, ``base_failed`` and ``kept``.

    A document fails the base rules with fewer than 50 words, or with more than half
    of its words in three-word windows that occur twice or more.  Of the others, those
    are kept that lose at most ``max_lost`` of their words with the lines that fail.
    A null text is an empty one.  Input columns named like an output are replaced.
    Every row is judged by itself: nothing is shuffled, repeated rows get equal
    verdicts, an empty table gives no rows.
    """
    added = [*COUNTS, "cleaned_text", "base_failed", "kept"]
    own = without(docs, text, *added)
    source = docs.select(*[F.col(f"`{c}`") for c in own.columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("cleaned_text"))
    schema = own.schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("cleaned_text", "string")
    measured = source.mapInArrow(lambda batches: _measured(batches, "cleaned_text"), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    lost = F.col("words_lost") > F.lit(float(max_lost)) * F.col("n_words")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~lost)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines removed; same columns as ``docs``."""
    judged = line_rules(docs).where("kept").withColumnRenamed("cleaned_text", "text")
    if "n_chars" in docs.columns:
        judged = judged.withColumn("n_chars", F.char_length("text").cast("long"))
    return judged.select(*docs.columns)
