"""Ranked text search (BM25) over blocks of postings, most of which a question never opens.

Rows are numbered in the order of their ids; ``span`` numbers are a block, and up to ``LOT``
numbers are a lot.  The index has a row for each term of a lot: the blocks that have the term and, as bytes,
the postings of each: for every row of the block that has the term, how far it is from the
one before, how often it has the term and how long it is.  Beside each block stands the
largest share any of its rows reaches, so the sum of a question's shares is more than any row
of that block can score.

A question first opens the blocks of largest sums.  Its k-th score there is a floor, and
of the others only those whose sum reaches the floor are opened.  So the result is exact.
A lot meets the questions in parts: no group holds more than the postings of one lot and the
terms of one part of the questions, whatever share of the rows has a term.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions import text as T
from corpuscle.operators.scoring import GRID
from corpuscle.session import discard, fresh_path, stage

K1, B = 1.2, 0.75  # how soon repeats saturate, and how much length counts
SPAN = 32  # numbers of one block: the fewer, the closer its bound
FIRST = 8  # blocks a question opens before it has a floor
LOT = 1 << 14  # numbers of one lot at most
WORDS = 1 << 22  # words of a lot, about; of its rows a task holds no more at once, if not of one row
PART = 1024  # questions that meet a lot together, about
CELLS = 1 << 20  # scores that a task holds at once, if not of one question
FINE = 65535  # steps of a largest share, which is kept rounded up
SLACK = 1e-9


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the numbers and how many each has: seven bits a byte, least first, the top bit set where a number goes on."""
    rest = values.astype(np.uint64)
    width = max(1, -(-int(rest.max(initial=0)).bit_length() // 7))
    used = np.ones(len(rest), dtype=np.int64)
    for j in range(1, width):
        used += rest >= np.uint64(1 << 7 * j)
    out, at, left = np.empty(int(used.sum()), dtype=np.uint8), np.cumsum(used) - used, used
    for j in range(width):
        out[at + j] = (rest & np.uint64(127)).astype(np.uint8) | ((left > 1).astype(np.uint8) << 7)
        more = left > 1
        rest, at, left = rest[more] >> np.uint64(7), at[more], left[more] - 1
    return out, used


def decode(raw: bytes) -> np.ndarray:
    """The numbers ``encode`` was given."""
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = 7 * (np.arange(len(data)) - np.repeat(first, last - first + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, first)


def share(freq: np.ndarray, size: np.ndarray, mean: float) -> np.ndarray:
    """Share of a term's weight that a row gets."""
    return freq / (freq + K1 * (1 - B + B * size / mean))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where one of the columns changes, and 0."""
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))


def _binary(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes cut at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def _lots(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows lot by lot; a lot of very many words comes in several tables."""
    held: list[pa.RecordBatch] = []
    last, words = -1, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lot, size = batch.column("_n").to_numpy() // rows, batch.column("_size").to_numpy().astype(np.int64)
        cuts = _starts(lot, np.cumsum(size) // WORDS)
        for at, upto in zip(cuts, [*cuts[1:], len(lot)]):
            more = int(size[at:upto].sum())
            if held and (lot[at] != last or words + more > WORDS):
                yield pa.Table.from_batches(held)
                held, words = [], 0
            held.append(batch.slice(at, upto - at))
            last, words = lot[at], words + more
    if held:
        yield pa.Table.from_batches(held)


def _lists(batches: Iterator[pa.RecordBatch], mean: float, span: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """A row for each term of a lot of so many blocks; rows come in the order of their numbers and all have words."""
    for table in _lots(batches, blocks * span):
        number, size = table.column("_n").to_numpy(), table.column("_size").to_numpy().astype(np.int64)
        words = table.column("_words").combine_chunks().flatten().dictionary_encode()
        code, owner = words.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(size)), size)
        each, freq = np.unique(code * len(size) + owner, return_counts=True)
        code, owner = np.divmod(each, len(size))
        block, at = np.divmod(number[owner], span)
        size = size[owner]
        starts = _starts(code, block)
        steps = np.diff(at, prepend=-1) - 1
        steps[starts] = at[starts]
        raw, used = encode(np.stack([steps, freq, size], axis=1).ravel())
        best = np.ceil(np.maximum.reduceat(share(freq, size, mean), starts) * FINE).astype("<u2")
        n = np.diff(starts, append=len(code))
        lot = int(number[0]) // (blocks * span)
        code, block = code[starts], block[starts] - lot * blocks
        lists = _starts(code)
        ends = np.append(lists[1:], len(code))
        steps = np.diff(block, prepend=0)
        steps[lists] = block[lists]
        places, taken = encode(np.stack([steps, n], axis=1).ravel())
        upto = np.cumsum(n)[ends - 1]
        yield pa.RecordBatch.from_arrays(
            [words.dictionary.take(pa.array(code[lists])), pa.array(np.full(len(lists), lot)), pa.array(np.diff(upto, prepend=0)),
             _binary(places, np.cumsum(taken)[2 * ends - 1]), _binary(best, 2 * ends), _binary(raw, np.cumsum(used)[3 * upto - 1])],
            names=["token", "lot", "n", "blocks", "best", "postings"])


def build_text_index(chunks: DataFrame, path: str, ids: list[str], text: str = "text", span: int = SPAN) -> None:
    """Write the rows of ``chunks`` and their postings below ``path``, which must not exist.

    ``ids`` identify a row; they order equal scores.  Rows are ranged by them once.  A lot
    belongs to one range of rows, so its postings are put together where its rows lie and
    are not shuffled.  Null texts have no terms.
    """
    spark = chunks.sparkSession
    staged = fresh_path(spark, "text-chunks")
    chunks.write.parquet(staged, compression="zstd")
    ranged = spark.read.schema(chunks.schema).parquet(staged).repartitionByRange(*ids).sortWithinPartitions(*ids)
    tokens = T.analyzed_tokens(F.coalesce(F.col(text), F.lit("")))
    numbered = ranged.withColumn("_n", F.monotonically_increasing_id()).withColumn("_size", F.size(tokens))
    numbered.write.parquet(f"{path}/rows", compression="zstd")
    discard(spark, staged)  # nothing reads it any more
    rows = spark.read.parquet(f"{path}/rows")
    sizes = rows.where("_size > 0").agg(F.count("*").alias("rows"), F.avg("_size").alias("mean"))
    mean = F.coalesce("mean", F.lit(1.0))
    blocks = F.greatest(F.lit(1), F.floor(F.least(F.lit(LOT), WORDS / mean) / span)).cast("int")
    sizes.select("rows", mean.alias("mean"), F.lit(span).alias("span"), blocks.alias("blocks")).coalesce(1).write.parquet(f"{path}/meta")
    meta = spark.read.parquet(f"{path}/meta").first()
    mean, blocks = meta["mean"], meta["blocks"]
    kind = "token string, lot long, n long, blocks binary, best binary, postings binary"
    lists = rows.where("_size > 0").select("_n", "_size", tokens.alias("_words")).mapInArrow(lambda b: _lists(b, mean, span, blocks), kind)
    lists.write.parquet(f"{path}/lists", compression="zstd")


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class _Lot:
    """What a lot holds of the terms of some questions: ``asks`` by question, ``entries`` of a term and a block by term."""

    def __init__(self, met: pa.Table, visitors: np.ndarray | None = None):
        asks = met.column("asks").combine_chunks()
        term = np.repeat(np.arange(met.num_rows), pc.list_value_length(asks).to_numpy())
        asks = asks.flatten()
        q, weight = asks.field("q").to_numpy(), asks.field("weight").to_numpy()
        if visitors is not None:
            held = np.isin(q, visitors)
            q, weight, term = q[held], weight[held], term[held]
            kept, term = np.unique(term, return_inverse=True)
            met = met.take(pa.array(kept))
        order = np.argsort(q, kind="stable")
        self.q, self.weight, self.term, self.met = q[order], weight[order], term[order], met
        self.entries = met.column("entries").to_numpy().astype(np.int64)
        self.entry_at = np.cumsum(self.entries) - self.entries
        steps, self.n = decode(b"".join(met.column("blocks").to_pylist())).reshape(-1, 2).T
        along = np.cumsum(steps)
        self.block = along - np.repeat(along[self.entry_at] - steps[self.entry_at], self.entries)

    def best(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.met.column("best").to_pylist()), dtype="<u2") / FINE

    def postings(self, mean: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where an entry's postings start; place in the block and share of every posting."""
        steps, freq, size = decode(b"".join(self.met.column("postings").to_pylist())).reshape(-1, 3).T
        starts, along = np.cumsum(self.n) - self.n, np.cumsum(steps + 1)
        return starts, along - np.repeat(along[starts] - steps[starts], self.n), share(freq, size, mean)

    def turns(self, cost: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ask and entry of all pairs of a few questions, and these questions, again and again; ``cost`` is told per ask."""
        firsts = _starts(self.q) if len(self.q) else np.zeros(0, dtype=np.int64)
        spent = np.cumsum(np.add.reduceat(cost(self.term), firsts)) if len(firsts) else firsts
        at = 0
        while at < len(firsts):
            upto = max(at + 1, int(np.searchsorted(spent, (spent[at - 1] if at else 0) + CELLS, side="right")))
            asks = np.arange(firsts[at], firsts[upto] if upto < len(firsts) else len(self.q))
            counts = self.entries[self.term[asks]]
            yield np.repeat(asks, counts), _ranges(self.entry_at[self.term[asks]], counts), self.q[firsts[at:upto]]
            at = upto


def _bounds(met: pa.Table, blocks: int) -> pa.Table:
    """The most that any row of a block can score, for all questions with a term in it."""
    lot, first = _Lot(met), met.column("lot")[0].as_py() * blocks
    best, found = lot.best(), []
    for ask, entry, asked in lot.turns(lambda term: lot.entries[term]):
        cell = np.searchsorted(asked, lot.q[ask]) * blocks + lot.block[entry]
        total = np.bincount(cell, lot.weight[ask] * best[entry], minlength=len(asked) * blocks)
        cell = np.flatnonzero(total)
        most = np.floor(total[cell] * (GRID * (1 + SLACK)) + 2).astype(np.int64)
        found.append(pa.table({"q": asked[cell // blocks], "block": first + cell % blocks, "most": most}))
    return pa.concat_tables(found)


def _opened(met: pa.Table, visits: pa.Table, k: int, mean: float, span: int, blocks: int) -> pa.Table:
    """The best ``k`` rows of each question in the blocks of one lot that it opens."""
    none = pa.table({"q": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "g": pa.array([], pa.float64())})
    if not visits.num_rows or not met.num_rows:
        return none
    first = met.column("lot")[0].as_py() * blocks
    visits = visits.sort_by([("q", "ascending"), ("block", "ascending")])
    q, block, floor = (visits.column(c).to_numpy() for c in ("q", "block", "floor"))
    lot, found = _Lot(met, np.unique(q)), [none]
    starts, place, part = lot.postings(mean)
    for ask, entry, asked in lot.turns(lambda term: lot.entries[term] * span):
        here = slice(np.searchsorted(q, asked[0]), np.searchsorted(q, asked[-1], side="right"))
        number = np.full(len(asked) * blocks, -1)
        number[np.searchsorted(asked, q[here]) * blocks + block[here] - first] = np.arange(here.stop - here.start)
        visit = number[np.searchsorted(asked, lot.q[ask]) * blocks + lot.block[entry]]
        ask, entry, visit = ask[visit >= 0], entry[visit >= 0], visit[visit >= 0]
        n = lot.n[entry]
        posting = _ranges(starts[entry], n)
        total = np.bincount(np.repeat(visit * span, n) + place[posting], np.repeat(lot.weight[ask], n) * part[posting], minlength=(here.stop - here.start) * span)
        total = np.floor(total * GRID + 0.5)
        cell = np.flatnonzero(total >= np.repeat(np.maximum(floor[here], 1.0), span))
        whose, row, score = q[here][cell // span], block[here][cell // span] * span + cell % span, total[cell]
        order = np.lexsort((row, -score, whose))
        whose, row, score = whose[order], row[order], score[order]
        kept = np.arange(len(whose)) - np.searchsorted(whose, whose) < k
        found.append(pa.table({"q": whose[kept], "n": row[kept], "g": score[kept]}))
    return pa.concat_tables(found)


class TextSearch:
    """One search in an index; ``bounds`` are all blocks that hold a term of a question, ``first`` and ``rest`` those opened."""

    def __init__(self, questions: DataFrame, path: str, k: int, question_id: str, question: str, first: int = FIRST):
        spark: SparkSession = questions.sparkSession
        self.k, self.path, self.question_id = k, path, question_id
        meta = spark.read.parquet(f"{path}/meta").first()
        self.mean, self.span = float(meta["mean"]), int(meta["span"])
        self.blocks = int(meta["blocks"])
        lists = spark.read.parquet(f"{path}/lists")
        self.asked = stage(questions.select(F.monotonically_increasing_id().alias("q"), F.col(question_id), F.col(question).alias("text")), "text-questions")
        words = self.asked.select("q", F.explode(T.analyzed_tokens(F.coalesce("text", F.lit("")))).alias("token")).groupBy("q", "token").count()
        # Of the index only the asked terms are looked at again.
        wanted = stage(lists.join(words.select("token").distinct(), "token", "left_semi"), "text-wanted")
        common = wanted.groupBy("token").agg(F.sum("n").alias("df"))
        rarity = F.log(1 + (F.lit(float(meta["rows"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        self.terms = stage(words.join(common, "token").select("q", "token", (F.col("count") * rarity).alias("weight")), "text-terms")
        self.parts = -(-self.asked.count() // PART)
        asks = self.terms.groupBy(self._part(), "token").agg(F.collect_list(F.struct("q", "weight")).alias("asks"))
        self.met = wanted.join(asks, "token").withColumn("entries", (F.octet_length("best") / 2).cast("int"))
        blocks = self.blocks
        bounds = self.met.select("lot", "part", "blocks", "entries", "best", "asks").groupBy("lot", "part").applyInArrow(lambda t: _bounds(t, blocks), "q long, block long, most long")
        order = Window.partitionBy("q").orderBy(F.desc("most"), "block")
        # The window's limit is applied before rows are shuffled.
        self.bounds = stage(bounds, "text-bounds")
        self.first = stage(
            self.bounds.withColumn("r", F.row_number().over(order)).where(F.col("r") <= first)
            .select("q", "block", F.lit(-math.inf).alias("floor")), "text-first")
        early = stage(self._best(self._hits(self.first)), "text-early")
        reached = early.groupBy("q").agg(F.count("*").alias("found"), F.min("g").alias("g"))
        floors = self.bounds.join(reached, "q").select(
            "q", "block", "most", F.when(F.col("found") >= k, F.col("g")).otherwise(F.lit(-math.inf)).alias("floor"))
        unseen = floors.join(self.first.select("q", "block"), ["q", "block"], "left_anti")
        self.rest = stage(unseen.where(F.col("most") >= F.col("floor")).select("q", "block", "floor"), "text-rest")
        self.hits = self._best(early.union(self._hits(self.rest)))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("q"), F.lit(max(self.parts, 1))).alias("part")

    def _hits(self, visits: DataFrame) -> DataFrame:
        k, mean, span, blocks = self.k, self.mean, self.span, self.blocks
        visits = visits.select(F.floor(F.col("block") / blocks).cast("long").alias("lot"), self._part(), "q", "block", "floor")
        met = self.met.select("lot", "part", "blocks", "entries", "postings", "asks")
        both = met.groupBy("lot", "part").cogroup(visits.groupBy("lot", "part"))
        return both.applyInArrow(lambda m, v: _opened(m, v, k, mean, span, blocks), "q long, n long, g double")

    def _best(self, hits: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("g"), "n"))
        return hits.withColumn("rank", place).where(F.col("rank") <= self.k).drop("rank")

    def result(self) -> DataFrame:
        rows = self.asked.sparkSession.read.parquet(f"{self.path}/rows")
        hits = self.hits.select(F.col("q").alias("_q"), F.col("n").alias("_at"), F.col("g").alias("_g"))
        asked = self.asked.select(F.col("q").alias("_q"), self.question_id)
        named = hits.join(asked, "_q").join(rows, F.col("_at") == F.col("_n"))
        place = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("_g"), "_at"))
        kept = [c for c in rows.columns if c not in ("_n", "_size")]
        return named.select(self.question_id, *kept, (F.col("_g") / GRID).alias("score"), place.alias("rank"))


def ranked_text(questions: DataFrame, path: str, k: int = 8, question_id: str = "question_id", question: str = "question") -> DataFrame:
    """The ``k`` rows of the index at ``path`` that score highest for each question, ranked from 1.

    Rows without a term of the question are not hits, so a question may have fewer than
    ``k``.  Repeated words of a question count as often as they are.  Equal scores go by the
    rows' ids.
    """
    return TextSearch(questions, path, k, question_id, question).result()


def text_index(chunks: DataFrame, ids: list[str], text: str = "text", span: int = SPAN) -> str:
    """An index in the shared folder, for one session; returns its path."""
    path = fresh_path(chunks.sparkSession, "text-index")
    build_text_index(chunks, path, ids, text, span)
    return path
