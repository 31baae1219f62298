"""Exact top-k by inner product over norm-sorted, rotated vectors.

Vectors are whole numbers, floor(scale * x).  Candidates are sorted by descending
length and cut into blocks; all are rotated onto the singular vectors of the whole
collection, which moves most of a product into its first dimensions.  With a floor f
for the k-th score of a query q, a block, a row or a pair is left out once an upper
bound falls below f:

* Cauchy-Schwarz on the whole vectors, for a block and then for each row of it,
* the partial product over the first dimensions plus Cauchy-Schwarz on the rest.

What is left is scored exactly in whole numbers.  A first pass over the longest
vectors sets the floors; within a task they rise block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.session import stage

SCALE = 256
BLOCK_BYTES = 512 * 1024
SLICE_BLOCKS = 4
NONE = np.iinfo(np.int64).min
CANDIDATES = "slice int, block int, longest double, ids binary, ints binary"
QUERIES = "part int, q_ids binary, q_ints binary, q_floors binary"
HITS = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, ints, square) of the rows that take part: an id, and finite components only."""
    x = F.col(f"`{vector}`")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ints = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.when(sound, ints).alias("ints")).where(
        "vec_id IS NOT NULL AND ints IS NOT NULL"
    ).withColumn("square", F.aggregate("ints", F.lit(0.0), lambda total, v: total + v.cast("double") * v))


def _matrix(ints: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors are filled up with zeros."""
    sizes = ints.value_lengths().to_numpy(zero_copy_only=False)
    flat = ints.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    at = 0
    for row, size in enumerate(sizes):
        out[row, :size] = flat[at:at + size]
        at += size
    return out


def _packed(ints: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each that hold all of them."""
    least, most = int(ints.min(initial=0)), int(ints.max(initial=0))
    kind = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return ints.astype(kind).tobytes()


def _unpacked(raw: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<i{len(raw) // (rows * dim)}").astype(np.int64).reshape(rows, dim)


def _gram(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dim, dim))
    for batch in batches:
        x = _matrix(batch.column("ints"), dim).astype(np.float64)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(dim), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"]
    )


def rotation(numbers: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows; only sums of products leave the tasks, dim * dim reach the driver."""
    parts = numbers.select("ints").mapInArrow(lambda b: _gram(b, dim), "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((dim, dim))
    for i, j, v in sums.collect():
        gram[i, j] = v
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _candidate_blocks(batches: Iterator[pa.RecordBatch], dim: int, rows: int) -> Iterator[pa.RecordBatch]:
    part, block = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            ints = _matrix(piece.column("ints"), dim)
            longest = float(np.sqrt(max(piece.column("square").to_pylist())))
            yield pa.RecordBatch.from_pylist([{
                "slice": part, "block": block, "longest": longest,
                "ids": piece.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes(), "ints": _packed(ints),
            }], schema=pa.schema([("slice", pa.int32()), ("block", pa.int32()), ("longest", pa.float64()), ("ids", pa.binary()), ("ints", pa.binary())]))
            block += 1


def _query_blocks(batches: Iterator[pa.RecordBatch], dim: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            floors = piece.column("kth").fill_null(int(NONE)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pylist([{
                "part": piece.column("part")[0].as_py(),
                "q_ids": piece.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                "q_ints": _packed(_matrix(piece.column("ints"), dim)), "q_floors": floors.astype("<i8").tobytes(),
            }], schema=pa.schema([("part", pa.int32()), ("q_ids", pa.binary()), ("q_ints", pa.binary()), ("q_floors", pa.binary())]))


class Winners:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, ints: np.ndarray, floors: np.ndarray, turn: np.ndarray, k: int, head: int):
        self.ids, self.ints, self.floors, self.k, self.head = ids, ints, floors.copy(), k, head
        self.turned = ints.astype(np.float64) @ turn
        self.norms = np.sqrt((self.turned**2).sum(axis=1))
        self.rest = np.sqrt((self.turned[:, head:] ** 2).sum(axis=1))
        self.largest = float(np.abs(ints).max(initial=0))
        self.query, self.vec, self.score = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, ids: np.ndarray, ints: np.ndarray, turn: np.ndarray) -> None:
        floors = self.floors.astype(np.float64)
        turned = ints.astype(np.float64) @ turn
        norms = np.sqrt((turned**2).sum(axis=1))
        longest = float(norms.max(initial=0.0))
        slack = 1 + 1e-9 * (1 + longest * float(self.norms.max(initial=0.0)))
        q = np.flatnonzero(self.norms * longest + slack >= floors)
        if not len(q):
            return
        least = float((floors[q] / np.maximum(self.norms[q], 1e-12)).min())
        x = np.flatnonzero(norms + slack / max(float(self.norms[q].min()), 1e-12) >= least)
        rest = np.sqrt((turned[x, self.head:] ** 2).sum(axis=1))
        bound = turned[x, :self.head] @ self.turned[q, :self.head].T + rest[:, None] * self.rest[q][None, :] + slack
        alive = bound >= floors[q]
        x, alive = x[alive.any(axis=1)], alive[alive.any(axis=1)]
        q, alive = q[alive.any(axis=0)], alive[:, alive.any(axis=0)]
        if not alive.size:
            return
        most = float(np.abs(ints).max(initial=0)) * self.largest * ints.shape[1]
        if most < 2**53:  # sums of doubles are exact below
            scores = (ints[x].astype(np.float64) @ self.ints[q].T.astype(np.float64)).astype(np.int64)
        else:
            scores = ints[x] @ self.ints[q].T
        scores[~alive | (ids[x][:, None] == self.ids[q][None, :])] = NONE
        if len(x) >= self.k:
            kth = np.partition(scores, len(x) - self.k, axis=0)[len(x) - self.k]
            self.floors[q] = np.maximum(self.floors[q], kth)
        row, col = np.nonzero((scores >= self.floors[q][None, :]) & (scores > NONE))
        self._keep(q[col], ids[x][row], scores[row, col])

    def _keep(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        query, vec, score = (np.concatenate(pair) for pair in ((self.query, query), (self.vec, vec), (self.score, score)))
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.k - 1
        self.floors[query[last]] = np.maximum(self.floors[query[last]], score[last])
        keep = rank < self.k
        self.query, self.vec, self.score = query[keep], vec[keep], score[keep]

    def hits(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[self.query]), pa.array(self.vec), pa.array(self.score)], names=["query_id", "vec_id", "score"]
        )


def _search(batches: Iterator[pa.RecordBatch], dim: int, turn: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks, those of one query block and slice together, long candidates first."""
    whole = lambda raw: np.frombuffer(raw, dtype="<i8").astype(np.int64)
    now, best = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            raw = batch.column("q_ids")[i].as_py()
            key = (batch.column("slice")[i].as_py(), raw)
            if key != now:
                if best is not None:
                    yield best.hits()
                asked = whole(raw)
                now, best = key, Winners(
                    asked, _unpacked(batch.column("q_ints")[i].as_py(), len(asked), dim),
                    whole(batch.column("q_floors")[i].as_py()), turn, k, max(1, dim // 4),
                )
            ids = whole(batch.column("ids")[i].as_py())
            best.add(ids, _unpacked(batch.column("ints")[i].as_py(), len(ids), dim), turn)
    if best is not None:
        yield best.hits()


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but those
    of the query's own id; ties go to the smaller id.  Rows with a null id, a null vector or
    a null or non-finite component take no part.  Shorter vectors are as if filled up with
    zeros, an empty one is a zero vector.  Scores must fit a long.  Rows of a repeated id are
    candidates each; as queries they share one list.  Fewer than k candidates give as many
    rows; no queries give none.  Other columns are ignored.

    Blocks of candidates and of queries meet once each: candidates are copied once per block
    of queries, queries once per slice of candidates, both by shuffles, and a task holds one
    block of either.
    """
    spark = vectors.sparkSession
    numbers = stage(whole_numbers(vectors, key, vector, scale), "whole-numbers")
    total, dim, asked = numbers.agg(
        F.count("*"), F.max(F.size("ints")), F.count(F.when(F.col("vec_id") % every == 0, 1))
    ).first()
    dim = max(1, dim or 1)
    rows = max(1, BLOCK_BYTES // (8 * dim))
    turn = rotation(numbers, dim)
    slices = max(1, -(-total // (rows * SLICE_BLOCKS)))
    blocks = stage(
        numbers.repartitionByRange(slices, F.desc("square"), F.col("vec_id")).sortWithinPartitions(F.desc("square"), "vec_id")
        .mapInArrow(lambda b: _candidate_blocks(b, dim, rows), CANDIDATES), "candidate-blocks",
    )
    highest = blocks.agg(F.max("slice")).first()[0]
    parts = max(1, -(-asked // rows))
    queries = numbers.where(F.col("vec_id") % every == 0).select("vec_id", "ints").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    )

    def searched(candidates: DataFrame, floors: DataFrame | None, last: int) -> DataFrame:
        asking = queries.withColumn("kth", F.lit(None).cast("long")) if floors is None else queries.join(
            floors, queries.vec_id == floors.query_id, "left"
        ).select("vec_id", "ints", "part", "kth")
        packed = asking.repartition(parts, "part").sortWithinPartitions("part", "vec_id")
        packed = stage(packed.groupBy("part").applyInArrow(lambda t: _as_blocks(t, dim, rows), QUERIES), "query-blocks")
        spread = packed.withColumn("q_slice", F.explode(F.sequence(F.lit(0), F.lit(last))))
        met = candidates.withColumn("c_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        # Spark sizes both sides without their copies and would send one whole through the driver.
        pairs = met.hint("merge").join(spread, (met.c_part == spread.part) & (met.slice == spread.q_slice))
        ordered = pairs.sortWithinPartitions("c_part", "slice", "q_ids", "block").select("slice", "ids", "ints", "q_ids", "q_ints", "q_floors")
        return ordered.mapInArrow(lambda b: _search(b, dim, turn, k), HITS)

    if highest is None or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = blocks.where("slice = 0 AND block = 0")
    seeds = _ranked(searched(first, None, 0), k).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    hits = searched(blocks, stage(seeds, "floors"), highest)
    return _ranked(hits, k).select("query_id", "rank", "vec_id", "score")


def _as_blocks(rows: pa.Table, dim: int, most: int) -> pa.Table:
    """Blocks of at most ``most`` queries of one part."""
    found = list(_query_blocks(iter(rows.combine_chunks().to_batches()), dim, most))
    return pa.Table.from_batches(found)
