"""Batched embedding of a text column with a pluggable model."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as ST

from corpuscle.functions.text import KEYWORD_TOKEN

PORTION = 4 << 20  # bytes of text that are Python strings at once, about
KNOWN_TOKENS = 100_000

Embedder = Callable[[list[str]], Sequence[Sequence[float]]]


def hashing_embedder(dim: int = 64) -> Callable[[], Embedder]:
    """Factory of the default model: signed feature hashing of the keywords.

    A token adds +1 or -1 to one position, both taken from its MD5.  Weights
    are integers, so scores do not depend on the order of summation.
    """

    class Places(dict):
        """Position of every token met so far, shifted by ``dim`` where the sign is negative."""

        def __missing__(self, word: str) -> int:
            if len(self) >= KNOWN_TOKENS:  # keeps the memory of a long task bounded
                self.clear()
            digest = hashlib.md5(word.encode()).hexdigest()
            place = self[word] = int(digest[:8], 16) % dim + dim * (int(digest[8], 16) % 2)
            return place

    def build() -> Embedder:
        token, places = re.compile(KEYWORD_TOKEN), Places()

        def embed(texts: list[str]) -> np.ndarray:
            words = [token.findall(text.lower()) for text in texts]
            sizes = [len(found) for found in words]
            at = np.fromiter(map(places.__getitem__, chain.from_iterable(words)), np.int64, count=sum(sizes))
            at += np.repeat(np.arange(len(texts)) * (2 * dim), sizes)
            counts = np.bincount(at, minlength=len(texts) * 2 * dim).reshape(len(texts), 2, dim)
            return (counts[:, 0] - counts[:, 1]).astype(np.float32)

        return embed

    return build


def embed_column(
    df: DataFrame,
    make_embedder: Callable[[], Embedder] | None = None,
    text: str = "text",
    vec: str = "vec",
    error: str = "embed_error",
    batch: int = 16,
    retries: int = 2,
    pause: float = 0.3,
) -> DataFrame:
    """Add the vector of ``text`` to every row, and what went wrong if it is null.

    The model is built once per task and called with groups of ``batch`` texts.
    A failing call is repeated after a pause that grows by ``pause`` seconds; a
    group that keeps failing, or comes back with another number of vectors, is
    embedded text by text.  Row and vector travel together, so the order of
    results cannot slip.  A text the model has no vector for gets null.
    """
    make = make_embedder or hashing_embedder()
    schema = ST.StructType(
        df.schema.fields
        + [ST.StructField(vec, ST.ArrayType(ST.FloatType())), ST.StructField(error, ST.StringType())]
    )

    def persist(call: Callable[[], object]) -> object:
        for attempt in range(retries + 1):
            try:
                return call()
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(pause * (attempt + 1))
        raise AssertionError("unreachable")

    def one(model: Embedder, item: str) -> tuple[object, str | None]:
        try:
            found = persist(lambda: model([item]))
            if len(found) != 1 or len(found[0]) == 0:
                return None, "no vector returned"
            return np.asarray(found[0], dtype=np.float32), None
        except Exception as failure:
            return None, f"{type(failure).__name__}: {failure}"

    def group(model: Embedder, items: list[str]) -> list[tuple[object, str | None]]:
        try:
            found = persist(lambda: model(items))
            if len(found) == len(items) and all(len(v) for v in found):
                return [(np.asarray(v, dtype=np.float32), None) for v in found]
        except Exception:
            pass
        return [one(model, item) for item in items]

    def portions(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = rows.column(rows.schema.get_field_index(text)).nbytes
        step = max(batch, -(-rows.num_rows // max(1, -(-size // PORTION))))
        step += -step % batch
        return (rows.slice(at, step) for at in range(0, rows.num_rows, step))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for rows in chain.from_iterable(map(portions, batches)):
            texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
            present = [i for i, item in enumerate(texts) if item is not None]
            vectors: list = [None] * len(texts)
            errors: list = ["null text"] * len(texts)
            for start in range(0, len(present), batch):
                at = present[start : start + batch]
                for i, (v, e) in zip(at, group(model, [texts[i] for i in at])):
                    vectors[i], errors[i] = v, e
            yield pa.RecordBatch.from_arrays(
                rows.columns + [pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())],
                names=schema.names,
            )

    return df.mapInArrow(run, schema)
