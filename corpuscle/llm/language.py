"""Language by compression: the language whose dictionary makes a text smallest.

For each language a raw-content dictionary is put together from the beginnings of
texts in it.  A text is lower-cased, marks and digits become spaces, and it is encoded
in pieces of ``PIECE`` bytes by zstandard once with each dictionary; sizes are summed
over all its pieces, so that what a long text says itself never outweighs the
dictionaries.  Every piece ends in the same run of spaces, which keeps also short ones
from being stored as they are.  The smallest sum names the language; a text whose two
smallest sums are close to one another is marked as rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import without

DICTIONARY = 1 << 16  # bytes of a language's dictionary, at most
SNIPPET = 1024  # code points that one text adds to it, at most
TEXTS = 160  # texts sampled for a dictionary, at most
LANGUAGES = 512  # languages learned, at most: those with most texts
ALL_DICTIONARIES = 1 << 25  # bytes of all dictionaries together, at most
LEVEL = 5
PIECE = 2048
MARGIN = 0.02  # share of its size by which the runner-up has to be larger
BITS = 0.25  # weight of a bit saved in the score
UNKNOWN = "und"

SLICE = 1 << 20
TAIL = b" " * 64
BREAKS = re.compile("[\\s\\d_!-/:-@\\[-`{-~¡-¿ -⁯　-〿]+")


@dataclass(frozen=True)
class Languages:
    """Dictionaries by language; of equal sizes the language named first wins."""

    dictionaries: dict[str, bytes]


def held_out(key: Column) -> Column:
    """Rows never learned from: CRC-32 of the key as text leaves 2 when divided by 4; a null key is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def plain(text: str) -> bytes:
    """Lower-cased, with one space for each run of marks, digits and spaces."""
    return BREAKS.sub(" ", text.lower()).encode("utf-8", "replace")


def dictionary(snippets: list[str], most: int) -> bytes:
    """Snippets in a row, cut to ``most`` bytes; those put last are found at the least distance."""
    return b" ".join(plain(s) for s in snippets)[:most]


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TEXTS, most: int = DICTIONARY,
) -> Languages:
    """Dictionaries from the texts of ``docs`` whose language is known and whose key is not held out.

    The texts of a language are dealt into ``texts`` buckets by a hash of the text, and the
    smallest other hash of each bucket is taken, a sample that needs no sorting, whatever
    share of the rows one language has; copies fall together.  So a language adds at most
    ``texts`` snippets of ``SNIPPET`` code points.  Null, empty and letterless texts and
    null or empty languages teach nothing; no rows give no languages.
    """
    known = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    known = known.where("lang <> '' AND text RLIKE '\\\\p{L}'").where(~held_out(F.col("key"))).select(
        "lang", F.pmod(F.xxhash64("text"), F.lit(texts)).alias("bucket"), F.xxhash64("text", F.lit(1)).alias("rank"),
        F.substring("text", 1, SNIPPET).alias("snippet"),
    )
    ranked = known.groupBy("lang", "bucket").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
    sizes = ranked.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    names = [r["lang"] for r in sizes]
    if not names:
        return Languages({})
    # At most LANGUAGES * texts rows of three short columns.
    first = F.broadcast(ranked.where(F.col("lang").isin(names)).select("lang", "bucket", "rank"))
    taken = known.join(first, ["lang", "bucket", "rank"]).groupBy("lang", "bucket").agg(F.min("snippet").alias("snippet"))
    by_name: dict[str, list[str]] = {n: [] for n in names}
    for row in taken.orderBy("lang", "bucket").collect():
        by_name[row["lang"]].append(row["snippet"])
    most = min(most, ALL_DICTIONARIES // len(names))
    return Languages({n: dictionary(s, most) for n, s in by_name.items()})


class Encoder:
    """Encoded sizes of a text with each dictionary."""

    def __init__(self, model: Languages):
        self.names = list(model.dictionaries)
        self.encoders = []
        for content in model.dictionaries.values():
            ready = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ready.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=ready, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int] | None:
        """One sum per language over the whole text; none if it has no letter."""
        totals, letters = [0] * len(self.encoders), False
        for at in range(0, len(text), SLICE):
            body = text[at:at + SLICE]
            letters = letters or any(map(str.isalpha, body))
            raw = plain(body)
            parts = [raw[i:i + PIECE] + TAIL for i in range(0, len(raw), PIECE)]
            for k, encoder in enumerate(self.encoders):
                totals[k] += sum(len(encoder.compress(p)) for p in parts)
        return totals if letters else None

    def judged(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        sizes = self.sizes(text) if text and self.names else None
        if sizes is None:
            return UNKNOWN, 0.0, 0.0
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        score = 1 / sum(2.0 ** (-8 * BITS * min(s - best, 500)) for s in sizes)
        margin = (sizes[order[1]] - best) / best if len(order) > 1 else math.inf
        return self.names[order[0]], score, margin


def _judged(batches: Iterator[pa.RecordBatch], model: Languages) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(model)
    for batch in batches:
        found = [encoder.judged(t.as_py()) for t in batch.column("__text")]
        names, scores, margins = zip(*found) if found else ((), (), ())
        kept = [c for c in batch.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())],
            names=[*kept, "lang_pred", "score", "margin"],
        )


def identify(docs: DataFrame, model: Languages, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``rejected``.

    ``margin`` is the share by which the runner-up is larger than the smallest encoding;
    below the argument of that name a row is ``rejected``, and its language is a guess.  A
    text that is null or has no letter, and every text where nothing was learned, is
    ``und`` with score 0 and rejected.  A single learned language has an infinite margin.
    Each row by itself, over its whole text: nothing is shuffled.  Repeated rows get equal
    answers; no rows give none; input columns named like an output are replaced.
    """
    own = without(docs, text, "lang_pred", "score", "margin", "rejected", "__text")
    source = docs.select(*[F.col(f"`{c}`") for c in own.columns], F.col(f"`{text}`").cast("string").alias("__text"))
    kind = own.schema.add("lang_pred", "string").add("score", "double").add("margin", "double")
    return source.mapInArrow(lambda b: _judged(b, model), kind).withColumn("rejected", F.col("margin") < margin)
