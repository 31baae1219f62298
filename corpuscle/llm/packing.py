"""Token sequences of fixed size, packed by minimum bin slack."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.llm.common import pieces, without
from corpuscle.session import stage

CAPACITY = 1024
END = 2
CACHED_CHUNKS = 600_000
TEXT_BYTES = 8_000_000
AT_ONCE = 1_000_000
JOINED = 500
ROWS_PER_GROUP = 20_000
LEAST_GROUPS = 64

SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
# A space between white space and white space, or between it and the end.  A zero byte is the mark of ``Encoder``.
RUN = rf"[{SPACE}] (?:[{SPACE}]|\z)|\x00"
BARE = "\0"
# Where words of the tokenizer end for certain: between a letter or digit and a sign, and on both sides of a single line break.
SIGN = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"
BREAK = rf"([^{SPACE}\x00])(\n)([^{SPACE}\x00])"
PLAIN = rf"\A[ \n][^{SPACE}]+\z"


class Encoder:
    """Ids of whole texts, from ids of their chunks.

    A byte-level BPE first cuts a text into words, each with the one space before it.
    So a text may be cut before any space that stands after another character than
    white space, or before a visible one, and the ids of the chunks are those of the
    text.  Chunks repeat, texts do not: each distinct chunk is looked up once, and one not
    met before is cut again, into words and signs that repeat more.  Only such a part that
    is new meets the tokenizer.  Texts with longer runs of white space at a cut, with a
    special token or with a zero byte are encoded whole.

    ``known`` has the keys of chunks and parts: what follows their space, or ``BARE`` and
    all of it where there is no space.  They are looked up by one dictionary encoding of
    them and the new keys, so no word becomes a Python string of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes of each token
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([BARE])  # no text has no ids
        self.starts, self.sizes, self.uses = (np.zeros(1, dtype=np.int64) for _ in range(3))
        self.ids, self.used = np.empty(1 << 16, dtype=np.uint32), 0

    def _forget(self) -> None:
        """Keep what was met again since this was last called, unless that is most."""
        kept = np.flatnonzero(self.uses > 1)
        known, sizes, ids = self.known, self.sizes[kept], self._ids_at(self.starts[kept], self.sizes[kept])
        self.clear()
        if 2 * len(kept) < CACHED_CHUNKS:
            keys = known.take(pa.array(kept))
            odd = np.flatnonzero(sizes > 0)  # the first key is there already
            self.known = pa.concat_arrays([self.known, keys.take(pa.array(odd))])
            self._store(ids, np.cumsum(sizes[odd]) - sizes[odd], sizes[odd])
            self.uses = np.zeros(len(self.starts), dtype=np.int64)

    def _ids_at(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of several runs of the pool, one after the other."""
        return self.ids[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]

    def _append(self, ids: np.ndarray) -> int:
        """Put ids behind the pool, and say where; they stay if ``used`` goes up."""
        while self.used + len(ids) >= len(self.ids):  # one place more than is used
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        return self.used

    def _store(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        first = self._append(ids)
        self.used += len(ids)
        self.starts, self.sizes = np.concatenate([self.starts, first + starts]), np.concatenate([self.sizes, sizes])

    def _encoded(self, texts: list[str]) -> Iterator[list[int]]:
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        at = 0
        while at < len(texts):
            upto = max(int(np.searchsorted(ends, ends[at] + AT_ONCE)), at + 1)
            # The fast form leaves out where in the text an id comes from.
            for found in self.tokenizer.encode_batch_fast(texts[at:upto], add_special_tokens=False):
                yield found.ids
            at = upto

    def _coded(self, *keys: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
        """The known keys and behind them the new ones, and the place of each key among these."""
        coded = pa.chunked_array([self.known, *(k for k in keys if len(k))]).dictionary_encode()
        codes = iter([c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks[1:]])
        return coded.chunk(coded.num_chunks - 1).dictionary, [next(codes) if len(k) else np.zeros(0, dtype=np.int32) for k in keys]

    def _slots(self, words: pa.Array, heads: np.ndarray) -> np.ndarray:
        """Where the ids of each word are, with a space before all but those at ``heads``."""
        met = len(self.known)
        keys, (codes, leads) = self._coded(words, _bare(words.take(pa.array(heads))))
        place = np.arange(len(keys))
        if len(keys) > met:
            place[met:] = self._learn(keys.slice(met))
        slots = place[codes]
        slots[heads] = place[leads]
        self.uses = np.concatenate([self.uses, np.zeros(len(self.starts) - len(self.uses), dtype=np.int64)])
        self.uses += np.bincount(slots, minlength=len(self.uses))
        return slots

    def _learn(self, fresh: pa.Array) -> np.ndarray:
        """Slots of new keys, after encoding those of their parts that are new."""
        met, bare = len(self.known), _flags(pc.starts_with(fresh, BARE))
        marked = pc.replace_substring_regex(fresh, SIGN, r"\1" + BARE + r"\2")
        for _ in range(2):  # a break may share its neighbour with the one before
            marked = pc.replace_substring_regex(marked, BREAK, r"\1" + BARE + r"\2" + BARE + r"\3")
        several = pc.count_substring(marked, BARE).to_numpy(zero_copy_only=False) > bare
        lists = pc.split_pattern(marked.filter(pa.array(several)), BARE)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        later = np.ones(len(flat), dtype=bool)
        later[np.cumsum(counts) - counts] = False
        parts = pc.if_else(pa.array(later), _bare(flat), flat)
        # What stands before the mark of a bare key is no part.
        own = later.copy()
        own[~later] = ~bare[several]
        known, (simple, part) = self._coded(fresh.filter(pa.array(~several)), parts.filter(pa.array(own)))
        self._encode_keys(known.slice(met))
        slots = np.empty(len(fresh), dtype=np.int64)
        slots[~several] = simple
        slots[several] = len(known) + np.arange(len(counts))
        self.known = pa.concat_arrays([known, fresh.filter(pa.array(several))])
        if len(counts):
            counts -= bare[several]
            sizes = np.add.reduceat(self.sizes[part], np.cumsum(counts) - counts)
            self._store(self._ids_at(self.starts[part], self.sizes[part]), np.cumsum(sizes) - sizes, sizes)
        self.uses = np.concatenate([self.uses, np.zeros(len(self.starts) - len(self.uses), dtype=np.int64)])
        self.uses += np.bincount(part, minlength=len(self.uses))
        return slots

    def _encode_keys(self, keys: pa.Array) -> None:
        """Store the ids of keys that need no further cut."""
        # A line break stands in for the missing space: plain keys may stand side by side in
        # one text, and the bytes of the tokens tell them apart.
        bare = _flags(pc.starts_with(keys, BARE))
        shown = pc.if_else(pa.array(bare), pc.replace_substring(keys, BARE, "\n"), pc.binary_join_element_wise(" ", keys, ""))
        plain = _flags(pc.match_substring_regex(shown, PLAIN))
        starts, sizes = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=np.int64)
        side = shown.filter(pa.array(plain))
        ends = np.cumsum(pc.binary_length(side).to_numpy(zero_copy_only=False), dtype=np.int64)
        texts = ["".join(side.slice(at, JOINED).to_pylist()) for at in range(0, len(side), JOINED)]
        ids = np.fromiter(chain.from_iterable(self._encoded(texts)), dtype=np.uint32)
        stops = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
        # The line break has an id of its own, which is left out.
        starts[plain] = np.concatenate([[0], stops])[:-1] + bare[plain]
        sizes[plain] = stops - starts[plain]
        others = np.flatnonzero(~plain)
        lists = list(self._encoded([t[b:] for t, b in zip(shown.take(pa.array(others)).to_pylist(), bare[others].tolist())]))
        sizes[others] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        starts[others] = len(ids) + np.cumsum(sizes[others]) - sizes[others]
        self._store(np.concatenate([ids, np.fromiter(chain.from_iterable(lists), dtype=np.uint32)]), starts, sizes)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, each text followed by ``end``, and the bounds of the texts."""
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        if len(self.known) > CACHED_CHUNKS:
            self._forget()
        whole = pc.match_substring_regex(texts, RUN)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        apart = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(pc.if_else(whole, "", texts) if len(apart) else texts, " ")
        chunks = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        heads, lasts = np.cumsum(chunks) - chunks, np.cumsum(chunks) - 1
        slots = self._slots(lists.flatten(), heads)
        starts, sizes = self.starts[slots], self.sizes[slots]
        if len(apart):
            # A text encoded whole stands behind the pool for now, as one chunk.
            found = [np.array(ids, dtype=np.uint32) for ids in self._encoded(texts.take(pa.array(apart)).to_pylist())]
            sizes[heads[apart]] = own = np.array([len(ids) for ids in found], dtype=np.int64)
            starts[heads[apart]] = self._append(np.concatenate(found)) + np.cumsum(own) - own
        sizes[lasts] += 1  # the place of ``end``
        out = self._ids_at(starts, sizes)
        bounds = np.concatenate([[0], np.cumsum(sizes)[lasts]])
        out[bounds[1:] - 1] = end
        return out, bounds


def _bare(words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(BARE, words, "")


def _flags(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


def _pieces_of(bounds: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of every piece; only a first piece may be short of capacity."""
    lengths = np.diff(bounds)
    count = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    head = lengths - (count - 1) * capacity
    start = np.where(number == 0, 0, head[doc] + (number - 1) * capacity)
    return doc, number, start, np.where(number == 0, head[doc], capacity)


_ENCODERS: dict[str, Encoder] = {}  # kept by a Python worker from task to task


def _tokenized(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder = _ENCODERS[path] if path in _ENCODERS else _ENCODERS.setdefault(path, Encoder(path))
    for batch in batches:
        for part in pieces(batch, "__text", TEXT_BYTES):
            ids, bounds = encoder.encode(part.column("__text").cast(pa.string()), end)
            doc, number, start, length = _pieces_of(bounds, capacity)
            ends = 4 * np.concatenate([[0], np.cumsum(length)])
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4", copy=False))]
            ).cast(pa.binary())
            names = [n for n in part.schema.names if n != "__text"]
            index = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n).take(index) for n in names),
                 pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), raw],
                names=[*names, "piece", "start", "length", "ids"],
            )


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text", end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the token sequences of ``docs``: its columns but ``text``, and piece, start, length, ids.

    A document is the ids of its text and ``end``; one longer than ``capacity`` is cut,
    the short piece first.  ``ids`` are little-endian unsigned 32-bit numbers.  A null
    text is an empty one and gives ``end`` alone.  ``tokenizer`` is the path of a
    byte-level BPE file, the same on every machine.  Input columns named like an output
    are replaced; repeated rows give repeated pieces; no rows give none.
    """
    own = without(docs, text, "piece", "start", "length", "ids", "__text")
    source = docs.select(*[F.col(f"`{c}`") for c in own.columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = own.schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids", "binary")
    return source.mapInArrow(lambda batches: _tokenized(batches, tokenizer, end, capacity), schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest feasible bin that holds the longest item there is: how many of each length.

    Subset sums as bits of an integer: bit s is set if the items looked at so far can fill
    s.  Items come in runs of 1, 2, 4, ... copies, long ones first; the search ends at a
    full bin.  Going back, an item is taken only where the sum was not reached before it,
    so long items are preferred.
    """
    longest = max(counts)
    room, mask = capacity - longest, (1 << (capacity - longest + 1)) - 1
    bits, history = 1, []
    for length in sorted(counts, reverse=True):
        left, run = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not bits >> room & 1:
            take = min(run, left)
            history.append((bits, length, take))
            bits |= bits << length * take & mask
            left, run = left - take, 2 * run
        if bits >> room & 1:
            break
    filled, chosen = bits.bit_length() - 1, {longest: 1}
    for before, length, take in reversed(history):
        if not before >> filled & 1:
            chosen[length] = chosen.get(length, 0) + take
            filled -= length * take
    return chosen


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack on a histogram: bins as (number of each length, how often).

    A bin found is used as often as there are items for it, so the number of searches
    follows the number of lengths, at most ``capacity``, and not that of the items.
    """
    counts, found = {k: v for k, v in counts.items() if v}, []
    while counts:
        pattern = fullest(counts, capacity)
        times = min(counts[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        found.append((pattern, times))
    return found


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: a place in a sequence of at most ``capacity``.

    Lengths must be from 1 to ``capacity``; others raise an error.  Places in a sequence
    are gapless from 0.  Sequence ids are numbers from 0.  Input columns named like an
    output are replaced; repeated rows get places of their own; no rows give none.

    The histogram of lengths is all the driver sees; it has at most ``capacity`` rows,
    and the table of bins made of it, which is broadcast, is bounded by it as well.  Items
    are numbered within their length through groups of about ``ROWS_PER_GROUP`` rows, so a
    length that a third of the items have is spread over many tasks.
    """
    own = without(items, "sequence_id", "offset", "__row", "__group")
    size = F.col(f"`{length}`")
    sound = F.when(size.between(1, capacity), size).otherwise(F.raise_error(F.lit(f"a length is not from 1 to {capacity}")).cast("long"))
    rows = stage(own.withColumn(length, sound.cast("long")).withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["n"]: r["count"] for r in rows.groupBy(size.alias("n")).count().collect()}
    places, sequence = [], 0
    taken = dict.fromkeys(counts, 0)
    for pattern, times in bin_patterns(counts, capacity):
        at = 0
        for n, copies in pattern.items():
            places.append((n, taken[n], taken[n] + copies * times, sequence, copies, at))
            taken[n], at = taken[n] + copies * times, at + n * copies
        sequence += times
    bins = rows.sparkSession.createDataFrame(
        places, "b_length long, b_from long, b_to long, b_sequence long, b_copies long, b_offset long"
    )
    groups = LEAST_GROUPS + sum(counts.values()) // ROWS_PER_GROUP
    keyed = rows.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    before = keyed.groupBy(size.alias("g_length"), F.col("__group").alias("g_group")).count().withColumn(
        "g_before", F.sum("count").over(Window.partitionBy("g_length").orderBy("g_group")) - F.col("count"),
    ).drop("count")
    inside = F.row_number().over(Window.partitionBy(length, "__group").orderBy("__row")) - 1
    numbered = keyed.withColumn("__in", inside).join(
        stage(before, "group-starts"), (size == F.col("g_length")) & (F.col("__group") == F.col("g_group"))
    ).withColumn("__n", F.col("__in") + F.col("g_before"))
    placed = numbered.join(F.broadcast(bins), (size == F.col("b_length")) & (F.col("__n") >= F.col("b_from")) & (F.col("__n") < F.col("b_to")))
    nth = F.col("__n") - F.col("b_from")
    return placed.select(
        *[F.col(f"`{c}`") for c in own.columns],
        (F.col("b_sequence") + F.floor(nth / F.col("b_copies"))).alias("sequence_id"),
        (F.col("b_offset") + nth % F.col("b_copies") * size).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with their ids, each with its place in a sequence."""
    return pack(token_pieces(docs, tokenizer, capacity=capacity), capacity=capacity)
