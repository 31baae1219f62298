"""Exact and approximate top-k search of many query vectors in a corpus of vectors.

Two physical forms give the same rows; the caller names the one to use:

* **scan**: the queries are shipped to every task in lots of bounded bytes, the
  corpus is read where it lies, once per lot, and each task passes on no more
  than k rows per query and block.  The corpus is not shuffled.  Of a lot that is
  one group, the k-th scores among the first rows of the corpus are floors below which
  tasks keep rows to themselves; a larger lot meets each block group by group.
* **cells**: the corpus is split into cells around sampled pivots.  A query first
  visits its nearest cells; the k-th score found there bounds, through the
  triangle inequality, which other cells can still hold a better row, and only
  those are visited, with that score as a floor.  Large cells are cut into blocks
  and queries of one cell into groups, so that no task holds more than one block
  and one group, whatever share of the rows a single cell attracts.  Ids and
  scores are all that is shuffled; the other columns join the final hits.

Stopping after the nearest cells gives the approximate search.

Vectors with a null or non-finite element, or so long that the sum of their
squares is not finite, take no part on either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpuscle.functions.vectors import cosine, cosine_strict, dot, euclidean_score, is_finite, literal_vector
from corpuscle.operators.cells import CellTable, nearest_first, open_cells, temporary_cells
from corpuscle.operators.scoring import GRID, METRICS, Block, Vectors, Winners
from corpuscle.session import stage

BLOCK = 8 << 20  # of corpus rows that many groups of queries meet at once


def top_k_single(corpus: DataFrame, query: list[float], k: int, ids: list[str], vec: str = "vec",
                 metric: str = "cosine") -> DataFrame:
    """Top ``k`` for one literal query vector, all of it in column expressions."""
    forms = {"cosine": cosine, "cosine_strict": cosine_strict, "euclidean": euclidean_score, "dot": dot}
    scored = corpus.where(is_finite(F.col(vec))).withColumn("score", forms[metric](literal_vector(query), F.col(vec)))
    return scored.orderBy(_grid(F.col("score")).desc(), *ids).limit(k).drop(vec)


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    ids: list[str],
    query_vec: str = "query_vec",
    vec: str = "vec",
    metric: str = "cosine",
    shard: str | None = None,
    fetch: int = 0,
    form: str = "scan",
    group_queries: int = 4096,
    group_bytes: int = 64 << 20,
    floor_rows: int = 2000,
    cells: int | None = None,
    probes: int | None = None,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """The ``k`` best corpus rows of every query, ranked from 1.

    Result: ``query_id``, all corpus columns but the vector, ``score`` and
    ``rank``.  ``ids`` identify a corpus row and order equal scores; query ids
    must be unique.  Rows without a finite vector are left out, on both sides.

    With ``shard``, each shard first keeps its ``max(fetch, k)`` best, then the
    shards are merged.  ``probes`` visits that many nearest cells only and is
    approximate; it implies the cells form.  All query vectors must have one
    dimension.

    The other arguments bound the memory of a task; neither they nor ``form``
    change the result.  A corpus that is costly to compute should be written
    first, as it is read more than once.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if form not in ("scan", "cells"):
        raise ValueError("form must be scan or cells")
    if k < 1:
        raise ValueError("k must be at least 1")
    queries = queries.select(query_id, query_vec).where(is_finite(F.col(query_vec)))
    corpus = corpus.where(F.col(vec).isNotNull())
    per_shard = max(fetch, k)
    kept = per_shard if shard else k

    if form == "scan" and probes is None:
        merged = []
        for lot, last in _lots(queries, query_vec, group_queries, group_bytes):
            scan = _Scan(lot, corpus, kept, query_id, query_vec, ids, vec, metric, group_queries)
            floor = scan.floor(floor_rows if lot.num_rows <= group_queries else 0)
            hits = _merge(scan.hits(floor), [query_id] + ([shard] if shard else []) + ["_part"], ids, kept)
            if not last or merged:
                # One lot of many: its hits are written, so that its queries need not stay.
                hits = stage(hits, "scan-hits")
                scan.shipped.destroy()
            merged.append(hits)
        return _final(reduce(DataFrame.union, merged), query_id, shard, ids, k, per_shard)

    queries, dim = _staged(queries, query_vec)
    table = temporary_cells(corpus, ids, vec, metric, cells, dim, apart=probes is None)
    return _in_cells(queries, table, k, query_id, query_vec, probes, shard, per_shard, block_bytes)


def top_k_in_cells(
    queries: DataFrame,
    path: str,
    k: int,
    query_id: str,
    query_vec: str = "query_vec",
    probes: int | None = None,
    shard: str | None = None,
    fetch: int = 0,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """``top_k`` in a corpus that ``build_cells`` has written; only visited cells are read."""
    table = open_cells(queries.sparkSession, path)
    queries, dim = _staged(queries.select(query_id, query_vec).where(is_finite(F.col(query_vec))), query_vec)
    if dim not in (0, table.geometry.dim):
        raise ValueError(f"the corpus was split for queries of {table.geometry.dim} dimensions")
    return _in_cells(queries, table, k, query_id, query_vec, probes, shard, max(fetch, k), block_bytes)


def _in_cells(queries: DataFrame, table: CellTable, k: int, query_id: str, query_vec: str, probes: int | None,
              shard: str | None, per_shard: int, block_bytes: int) -> DataFrame:
    search = _CellSearch(queries, table, per_shard if shard else k, query_id, query_vec, shard, block_bytes)
    hits = search.exact() if probes is None else search.nearest(probes)
    ranked = _final(hits, query_id, shard, table.ids, k, per_shard)
    carried = set(search.carried)
    payload = [c for c in table.rows.columns if c not in {table.vec, "_cell", "_dist"}]
    if carried.issuperset(payload):
        return ranked.drop("_cell").select(query_id, *payload, "score", "rank")
    named = table.rows.select(F.col("_cell").alias("_at"), *[F.col(c).alias(f"_id_{c}") for c in table.ids],
                              *[c for c in payload if c not in carried])
    same = [F.col(c).eqNullSafe(F.col(f"_id_{c}")) for c in table.ids] + [F.col("_cell") == F.col("_at")]
    return ranked.join(named, reduce(lambda a, b: a & b, same)).select(query_id, *payload, "score", "rank")


def _lots(queries: DataFrame, query_vec: str, rows: int, size: int) -> Iterator[tuple[pa.Table, bool]]:
    """The queries in lots of about ``size`` bytes at most, and whether a lot is the last; ``rows`` and fewer are one."""
    head = queries.limit(rows + 1).toArrow()
    if head.num_rows <= rows and head.nbytes <= size:
        yield head, True
        return
    queries, dim = _staged(queries, query_vec)
    most = max(1, size // (16 * max(dim, 1)))  # half of it for ids
    count = -(-queries.count() // most)
    lots = queries.withColumn("_lot", F.pmod(F.xxhash64(*queries.columns), F.lit(count)))
    for number in range(count):
        yield lots.where(F.col("_lot") == number).drop("_lot").toArrow(), number == count - 1


def _staged(queries: DataFrame, query_vec: str) -> tuple[DataFrame, int]:
    """The queries written to the shared folder, and their dimension."""
    queries = stage(queries, "search-queries")
    size = F.size(query_vec)
    low, high = queries.agg(F.min(size), F.max(size)).first()
    if low != high:
        raise ValueError("query vectors differ in dimension")
    return queries, high or 0


def _grid(score: Column) -> Column:
    return F.floor(score * GRID + 0.5)


def _merge(hits: DataFrame, groups: list[str], ids: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*groups).orderBy(F.col("_score").desc(), *ids)
    return hits.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k).drop("_rank")


def _final(hits: DataFrame, query_id: str, shard: str | None, ids: list[str], k: int, per_shard: int) -> DataFrame:
    if shard:
        hits = _merge(hits, [query_id, shard], ids, per_shard)
    best = Window.partitionBy(query_id).orderBy(F.col("_score").desc(), *ids)
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("score", F.col("_score") / GRID).drop("_score", "_part")


def _hit_schema(corpus: DataFrame, vec: str, query_field: ST.StructField, extra: list) -> ST.StructType:
    payload = [f for f in corpus.schema.fields if f.name != vec]
    return ST.StructType([query_field, *payload, ST.StructField("_score", ST.DoubleType()), *extra])


def _query_vectors(table: pa.Table, query_vec: str, dim: int | None = None) -> Vectors:
    vectors = Vectors(table.column(query_vec), dim)
    if not np.all(vectors.sizes == vectors.dim):
        raise ValueError("query vectors differ in dimension")
    return vectors


def _named(hits: pa.Table, query_ids: pa.ChunkedArray, order: list[str], query_id: str) -> pa.Table:
    named = hits.append_column(query_id, query_ids.take(hits.column("_query")))
    return named.select(order)


class _Scan:
    """The search that ships the queries to the corpus; see the head of this module."""

    def __init__(self, few: pa.Table, corpus: DataFrame, k: int, query_id: str, query_vec: str,
                 ids: list[str], vec: str, metric: str, at_once: int = 4096):
        _query_vectors(few, query_vec)  # raises here rather than in every task
        self.few, self.corpus, self.k, self.at_once = few, corpus, k, at_once
        self.query_id, self.query_vec, self.ids, self.vec, self.metric = query_id, query_vec, ids, vec, metric
        spark = corpus.sparkSession
        self.shipped = spark.sparkContext.broadcast(few)
        # Merging in groups of tasks keeps the last merge small when a large
        # corpus has very many tasks.
        self.merge_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def hits(self, floor: np.ndarray | None = None) -> DataFrame:
        """The best rows each task has seen, none below ``floor``."""
        query_id, query_vec, vec = self.query_id, self.query_vec, self.vec
        k, metric, ids, shipped, merge_parts, at_once = self.k, self.metric, self.ids, self.shipped, self.merge_parts, self.at_once
        part_field = ST.StructField("_part", ST.IntegerType())
        schema = _hit_schema(self.corpus, vec, _arrow_field(self.few, query_id), [part_field])
        order = [f.name for f in schema.fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            table = shipped.value

            def named(found: pa.Table | None, asked: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
                if found is not None:
                    found = found.append_column("_part", pa.array(np.full(found.num_rows, task % merge_parts), pa.int32()))
                    yield from _named(found, asked, order, query_id).to_batches(10_000)

            if table.num_rows <= at_once:
                winners = Winners(_query_vectors(table, query_vec), k, metric, ids, floor)
                for batch in batches:
                    winners.offer(pa.Table.from_batches([batch]), vec)
                yield from named(winners.result(), table.column(query_id))
                return
            # Many groups: each meets a block before the next block comes, and keeps its floors alone.
            groups = [slice(at, min(at + at_once, table.num_rows)) for at in range(0, table.num_rows, at_once)]
            floors = np.full(table.num_rows, -np.inf) if floor is None else floor.copy()
            dim = _query_vectors(table.slice(0, 1), query_vec).dim
            for rows in _blocks(batches):
                block = Block(rows, vec, ids, dim)
                for group in groups:
                    asked = table.slice(group.start, group.stop - group.start)
                    winners = Winners(_query_vectors(asked, query_vec), k, metric, ids, floors[group])
                    winners.meet(block)
                    found = winners.result()
                    floors[group] = winners.floor
                    yield from named(found, asked.column(query_id))

        return self.corpus.mapInArrow(run, schema)

    def floor(self, rows: int) -> np.ndarray:
        """Per query the k-th score among the first ``rows`` rows of the corpus, or none.

        The k-th score of any part of the corpus is one the whole reaches, so
        rows below it cannot be results.  Only the partitions that hold these
        rows are read.
        """
        winners = Winners(_query_vectors(self.few, self.query_vec), self.k, self.metric, [])
        head = self.corpus.select(self.vec).limit(rows).collect() if rows and self.few.num_rows else []
        if head:
            kind = pa.list_(pa.float64())
            winners.offer(pa.table({self.vec: pa.array([row[0] for row in head], kind), "_n": pa.array(range(len(head)))}), self.vec)
            winners.result()
        return winners.floor


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``BLOCK`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= BLOCK:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _arrow_field(table: pa.Table, name: str) -> ST.StructField:
    from pyspark.sql.pandas.types import from_arrow_type

    return ST.StructField(name, from_arrow_type(table.schema.field(name).type))


class _CellSearch:
    """One search in a split corpus; see the head of this module."""

    def __init__(self, queries: DataFrame, table: CellTable, k: int, query_id: str, query_vec: str,
                 shard: str | None, block_bytes: int):
        self.queries = queries.withColumn("_floor", F.lit(float("-inf")))
        self.table, self.k, self.query_id, self.query_vec = table, k, query_id, query_vec
        self.carried = list(dict.fromkeys(table.ids + ([shard] if shard else [])))
        self.most = max(1, block_bytes // (8 * max(table.geometry.dim, 1)))  # vectors of a block, queries of a group
        self.blocks = np.maximum(-(-table.counts // self.most), 1)

    def _visits(self, queries: DataFrame, choose) -> DataFrame:
        """The cells every query has to visit; ``choose`` gives their mask for a batch."""
        geometry, pivots, name = self.table.geometry, self.table.pivots, self.query_vec
        schema = ST.StructType(self.queries.schema.fields + [ST.StructField("_cells", ST.ArrayType(ST.IntegerType()))])
        order = self.queries.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                for at in range(0, table.num_rows, 1000):
                    part = table.slice(at, 1000)
                    points = geometry.points(Vectors(part.column(name), geometry.dim), queries=True)
                    chosen = choose(points, part, pivots)
                    ends = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))]).astype(np.int32)
                    cells = pa.array(np.nonzero(chosen)[1].astype(np.int32))
                    listed = pa.ListArray.from_arrays(pa.array(ends), cells)
                    yield from part.select(order).append_column("_cells", listed).to_batches()

        return queries.mapInArrow(run, schema)

    def _score(self, visits: DataFrame) -> DataFrame:
        """Meet visits and corpus rows in blocks of bounded size and keep the best."""
        table = self.table
        visits = stage(visits, "search-visits").withColumn("_cell", F.explode("_cells")).drop("_cells")
        asked = {row._cell: row["count"] for row in visits.groupBy("_cell").count().collect()}  # one row per cell
        groups = [max(1, -(-asked.get(cell, 0) // self.most)) for cell in range(len(self.blocks))]

        def per_cell(counts) -> Column:
            return F.element_at(F.array(*[F.lit(int(n)) for n in counts] or [F.lit(1)]), F.col("_cell") + 1)

        def any_of(n: Column, *on: str) -> Column:
            return F.pmod(F.xxhash64(*on), n).cast("int")

        def all_of(n: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

        blocks, groups = per_cell(self.blocks), per_cell(groups)
        left = (
            table.rows.select(*self.carried, table.vec, "_cell").where(F.col("_cell").isin(list(asked)))
            .withColumn("_block", any_of(blocks, *table.ids))
            .withColumn("_group", all_of(groups))
        )
        right = visits.withColumn("_block", all_of(blocks)).withColumn("_group", any_of(groups, self.query_id))
        key = ["_cell", "_block", "_group"]
        k, metric, ids, vec = self.k, table.geometry.metric, table.ids, table.vec
        query_id, query_vec = self.query_id, self.query_vec
        schema = _hit_schema(table.rows.select(*self.carried, "_cell"), vec, self.queries.schema.fields[0], [])
        order = [f.name for f in schema.fields]

        def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
            hits = None
            if rows.num_rows and asked.num_rows:
                floor = asked.column("_floor").to_numpy()
                winners = Winners(_query_vectors(asked, query_vec), k, metric, ids, floor)
                block = rows.drop_columns(["_block", "_group"])
                for at in range(0, block.num_rows, 10_000):
                    winners.offer(block.slice(at, 10_000), vec)
                hits = winners.result()
            if hits is None:
                return rows.slice(0, 0).drop_columns(["_block", "_group", vec]).append_column(
                    query_id, asked.column(query_id).slice(0, 0)
                ).append_column("_score", pa.array([], pa.float64())).select(order)
            return _named(hits, asked.column(query_id), order, query_id)

        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, schema)

    def nearest(self, probes: int) -> DataFrame:
        def choose(points, part, pivots):
            chosen = np.zeros((len(points), len(pivots)), dtype=bool)
            np.put_along_axis(chosen, nearest_first(points, pivots)[:, :probes], True, axis=1)
            return chosen

        return self._score(self._visits(self.queries, choose))

    def exact(self) -> DataFrame:
        k, counts, geometry, radius = self.k, self.table.counts, self.table.geometry, self.table.radius

        def first(points, part, pivots):
            near = nearest_first(points, pivots)
            seen = np.cumsum(counts[near], axis=1) - counts[near]
            chosen = np.zeros(near.shape, dtype=bool)
            np.put_along_axis(chosen, near, seen < k, axis=1)
            return chosen & (counts > 0)[None, :]

        early = stage(_merge(self._score(self._visits(self.queries, first)), [self.query_id], self.table.ids, k),
                      "search-first-hits")
        reached = early.groupBy(self.query_id).agg(
            F.count("*").alias("_found"), F.min("_score").alias("_kth")
        )
        bounded = self.queries.join(reached, self.query_id, "left").select(
            self.query_id, self.query_vec,
            F.when(F.col("_found") >= k, F.col("_kth")).otherwise(F.lit(float("-inf"))).alias("_floor"),
        )

        def rest(points, part, pivots):
            kth = part.column("_floor").to_numpy() / GRID
            bound = geometry.upper_bounds(points, pivots, radius)
            return (bound >= kth[:, None]) & (counts > 0)[None, :] & ~first(points, part, pivots)

        late = self._score(self._visits(bounded, rest))
        return early.unionByName(late)
