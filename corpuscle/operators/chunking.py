"""Cut texts into chunks and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.functions.binding import bind


_MARK, _NOT_MARK = "\x1e", "\x1f"  # two control characters


def _cut(text: Column, size: int | Column) -> Column:
    """The text in pieces of ``size`` code points, the last one shorter; one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}+"), F.lit(0))


def fixed_windows(clean: Column, max_chars: int, overlap: int) -> Column:
    """Windows of ``max_chars`` at every multiple of the stride below the length.

    The last window may lie fully inside the one before it.  Lengths count
    code points.  The text is cut once into pieces of one stride, and a window is
    put together from the pieces it covers, so the work is in proportion to the text.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be at least 1")
    stride = max(max_chars - overlap, 1)
    covered = -(-max_chars // stride)

    def windows(pieces: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(pieces)),
            lambda at: F.substring(F.array_join(F.slice(pieces, at, F.lit(covered)), ""), F.lit(1), F.lit(max_chars)),
        )

    def cut(text: Column) -> Column:
        n = F.length(text)
        return (
            F.when(n == 0, F.array().cast("array<string>"))
            .when(n <= max_chars, F.array(text))
            .otherwise(bind(_cut(text, stride), windows))
        )

    return bind(clean, cut)


def packed_paragraphs(
    raw: Column, max_len: int = 1200, min_len: int = 120, separator: str = r"\n{2,}"
) -> Column:
    """Pack paragraphs greedily, joined by a newline, into pieces of ``max_len``.

    A paragraph longer than ``max_len`` is cut into pieces of its own.  Pieces
    are sanitised, and those shorter than ``min_len`` dropped.

    The paragraphs are joined by a mark none of them holds, and one pass of a pattern takes
    the pieces: from the start of a paragraph as far as the last mark within reach, or, where
    there is none, from within the long paragraph.  Sanitising turns every control
    character into a space, so the mark stands for the newline, and a mark that a
    paragraph holds by itself may give way to another control character.
    """
    if max_len < 1 or min_len < 1:
        raise ValueError("max_len and min_len must be at least 1")
    trimmed = F.transform(F.split(raw, separator), lambda p: F.replace(T.edge_trim(p), F.lit(_MARK), F.lit(_NOT_MARK)))
    joined = F.array_join(F.filter(trimmed, T.has_text), _MARK)
    piece = rf"(?s)(?<![^{_MARK}]).{{1,{max_len}}}(?={_MARK}|\z)|[^{_MARK}]{{1,{max_len}}}"
    cleaned = F.transform(F.regexp_extract_all(joined, F.lit(piece), F.lit(0)), T.sanitize)
    return F.filter(cleaned, lambda piece: T.long_enough(piece, min_len))


def chunk(docs: DataFrame, text: str = "text", max_chars: int = 1000, overlap: int = 200) -> DataFrame:
    """One row per window: ``chunk_id`` from 0 and the window in place of the text."""
    cleaned = docs.withColumn(text, T.chunk_normalize(F.col(text)))
    return _numbered(cleaned, text, fixed_windows(F.col(text), max_chars, overlap))


def chunk_by_paragraph(
    docs: DataFrame,
    text: str = "text",
    max_len: int = 1200,
    min_len: int = 120,
    separator: str = r"\n{2,}",
) -> DataFrame:
    """As ``chunk``, with packed paragraphs of the raw text."""
    return _numbered(docs, text, packed_paragraphs(F.col(text), max_len, min_len, separator))


def _numbered(docs: DataFrame, text: str, pieces: Column) -> DataFrame:
    kept = [F.col(c) for c in docs.columns if c != text]
    exploded = docs.select(*kept, F.posexplode(pieces).alias("chunk_id", text))
    return exploded.withColumn("chunk_id", F.col("chunk_id").cast("long"))


def explode_tokens(chunks: DataFrame, tokens: Column, keep: list[str]) -> DataFrame:
    """One row per token, in column ``token``, next to the ``keep`` columns."""
    return chunks.select(*keep, F.explode(tokens).alias("token"))
