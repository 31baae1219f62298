"""Approximate search over byte codes: residual product quantisation.

Rows are split into cells around pivots.  What a row's point differs by from its pivot, its
residual, is cut into parts of a few coordinates, and each part is replaced by the number of
the nearest of at most 256 typical ones, so that a row is as many bytes as it has parts.  A
query looks up its product with every typical part once; the score of a row is that with
its pivot plus one table entry per byte.  The rows of best approximate scores alone are read
as vectors and scored exactly, so scores and their order are exact, and a row can be missed.

Typical parts come from a bounded sample of rows; every row is encoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpuscle.functions.vectors import is_finite
from corpuscle.operators.cells import CellTable, build_cells, nearest_first, open_cells
from corpuscle.operators.scoring import GRID, STRIPES, Vectors, paired, shortlist, striped
from corpuscle.session import stage

SAMPLE = 20_000  # rows that typical parts are learned from, at most
WORDS = 256  # typical parts, at most: a number of one byte
PASSES = 12
AT_ONCE = 16  # queries whose rough products with a block are held at once
BLOCK = 1 << 16  # rows and queries that meet in one task, at most


@dataclass(frozen=True)
class Codebook:
    """Typical parts: for each part an array of words by coordinates."""

    words: list[np.ndarray]
    dim: int

    def cuts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([w.shape[1] for w in self.words])])

    def encode(self, residuals: np.ndarray) -> np.ndarray:
        cuts = self.cuts()
        out = np.zeros((len(residuals), len(self.words)), dtype=np.uint8)
        for p, words in enumerate(self.words):
            out[:, p] = nearest(residuals[:, cuts[p]:cuts[p + 1]], words)
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        cuts = self.cuts()
        out = np.empty((len(codes), cuts[-1]))
        for p, words in enumerate(self.words):
            out[:, cuts[p]:cuts[p + 1]] = words[codes[:, p]]
        return out

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """For each query its product with every word of every part."""
        cuts = self.cuts()
        out = np.zeros((len(queries), len(self.words), WORDS))
        for p, words in enumerate(self.words):
            out[:, p, :len(words)] = queries[:, cuts[p]:cuts[p + 1]] @ words.T
        return out


def _runs(rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each number of a sorted array with where it starts and ends."""
    found, starts = np.unique(rows, return_index=True)
    yield from zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(rows)])


def _rough(decoded: np.ndarray) -> np.ndarray | None:
    """Decoded residuals for ``shortlist``; none for few rows or extreme norms."""
    most = float(np.sqrt(np.einsum("ij,ij->i", decoded, decoded).max(initial=0.0)))
    return striped((decoded / most).astype(np.float32)) if len(decoded) >= STRIPES ** 2 and 1e-100 < most < 1e100 else None


def _short(queries: np.ndarray, rough: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of a query and a row that can be among its ``k`` best by their codes; none if they are many."""
    norms = np.linalg.norm(queries, axis=1)
    if not (1e-100 < norms.min() and norms.max() < 1e100):
        return None
    unit = (queries / norms[:, None]).astype(np.float32)
    return shortlist(unit, rough, n, k, np.full(len(queries), -np.inf), np.zeros(len(queries)))


def nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin(np.einsum("ij,ij->i", words, words)[None, :] - 2.0 * rows @ words.T, axis=1)


def typical(rows: np.ndarray, words: int = WORDS, passes: int = PASSES) -> np.ndarray:
    """Means of the groups that rows fall into around them, from an even choice of distinct rows."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= words:
        return distinct
    found = distinct[np.linspace(0, len(distinct) - 1, words).astype(int)]
    for _ in range(passes):
        group = nearest(rows, found)
        sizes = np.bincount(group, minlength=words)
        sums = np.stack([np.bincount(group, rows[:, j], minlength=words) for j in range(rows.shape[1])], axis=1)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


def _residuals(rows: pa.Table, table: CellTable) -> np.ndarray:
    dim = table.geometry.dim
    points = table.geometry.points(Vectors(rows.column(table.vec), dim))[:, :dim]
    return points - table.pivots[rows.column("_cell").to_numpy()][:, :dim]


def _learn(table: CellTable, parts: int, sample: int) -> Codebook:
    """Typical parts of the rows that come first by the hash of their ids."""
    mixed = F.xxhash64(*[F.col(c) for c in table.ids])
    few = table.rows.select(table.vec, "_cell", mixed.alias("_order")).orderBy("_order").limit(sample).toArrow()
    residuals = _residuals(few, table) if few.num_rows else np.zeros((0, table.geometry.dim))
    pieces = np.array_split(np.arange(table.geometry.dim), min(parts, max(table.geometry.dim, 1)))
    return Codebook([typical(residuals[:, p]) for p in pieces], table.geometry.dim)


def build_quantized(
    corpus: DataFrame, path: str, ids: list[str], vec: str = "vec", metric: str = "cosine", cells: int | None = None,
    parts: int = 32, sample: int = SAMPLE,
) -> None:
    """Write cells, codes and typical parts of a corpus below ``path``, which must not exist.

    ``metric`` is cosine or dot.  ``parts`` is the number of bytes of a row.  ``ids`` identify
    a row.  Rows without a finite vector are left out, as in ``build_cells``.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError("metric must be cosine or dot")
    spark = corpus.sparkSession
    table = build_cells(corpus, f"{path}/cells", ids, vec, metric, cells)
    book = _learn(table, parts, sample)
    rows = [(p, w, [float(x) for x in word]) for p, words in enumerate(book.words) for w, word in enumerate(words)]
    # At most parts * 256 rows.
    spark.createDataFrame(rows, "part int, word int, centre array<double>").coalesce(1).write.parquet(f"{path}/words")
    schema = ST.StructType([table.rows.schema[c] for c in ids] + [ST.StructField("_cell", ST.IntegerType()), ST.StructField("code", ST.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch])
            if found.num_rows:
                codes = book.encode(_residuals(found, table_parts))
                yield from found.select([*ids, "_cell"]).append_column("code", pa.array([c.tobytes() for c in codes], pa.binary())).to_batches()

    table_parts = CellTable(None, table.pivots, table.counts, table.radius, table.geometry, table.ids, table.vec)
    codes = table.rows.select(*ids, vec, "_cell").mapInArrow(run, schema)
    codes.hint("rebalance", "_cell").write.partitionBy("_cell").parquet(f"{path}/codes")


def _open_words(spark: SparkSession, path: str, dim: int) -> Codebook:
    rows = spark.read.parquet(f"{path}/words").orderBy("part", "word").collect()
    words: dict[int, list] = {}
    for row in rows:
        words.setdefault(row.part, []).append(row.centre)
    return Codebook([np.array(words[p]) for p in sorted(words)], dim)


def top_k_quantized(
    queries: DataFrame, path: str, k: int, query_id: str, query_vec: str = "query_vec", probes: int | None = None, rerank: int | None = None,
) -> DataFrame:
    """About the ``k`` best rows of every query in what ``build_quantized`` has written.

    Result: ``query_id``, the columns of the corpus but its vector, ``score`` and ``rank``.
    Codes are read in the ``probes`` nearest cells, or in all; the vectors of the ``rerank`` rows
    with the best approximate scores (five times ``k`` by default) are read and scored
    exactly.  Equal scores go by the ids.  Queries without a finite vector have no rows.
    """
    spark = queries.sparkSession
    table = open_cells(spark, f"{path}/cells")
    dim, metric, ids, vec = table.geometry.dim, table.geometry.metric, table.ids, table.vec
    book = _open_words(spark, path, dim)
    most = max(rerank or 5 * k, k)
    asked = stage(queries.select(query_id, F.col(query_vec).cast("array<double>").alias("_asked")).where(is_finite(F.col("_asked")) & (F.size("_asked") == dim)), "quantized-queries")
    codes = spark.read.parquet(f"{path}/codes")
    n_cells = len(table.pivots)
    geometry, pivots = table.geometry, table.pivots
    visits_schema = ST.StructType([*asked.schema.fields, ST.StructField("_cells", ST.ArrayType(ST.IntegerType()))])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = geometry.points(Vectors(batch.column("_asked"), dim), queries=True)
            near = nearest_first(points, pivots)[:, :probes or n_cells].astype(np.int32)
            yield batch.append_column("_cells", pa.array(list(near), pa.list_(pa.int32())))

    # Rows of a cell and queries that visit it meet in blocks of bounded size.
    visits = stage(asked.mapInArrow(visit, visits_schema), "quantized-visits").withColumn("_cell", F.explode("_cells")).drop("_cells")
    visitors = {r["_cell"]: r["count"] for r in visits.groupBy("_cell").count().collect()}  # one row per cell
    blocks = [max(1, -(-int(n) // BLOCK)) for n in table.counts] or [1]
    groups = [max(1, -(-visitors.get(c, 0) // 1024)) for c in range(n_cells)] or [1]
    count = lambda counts: F.element_at(F.array(*[F.lit(n) for n in counts]), F.col("_cell") + 1)
    every = lambda counts: F.explode(F.sequence(F.lit(0), count(counts) - 1))
    one = lambda counts, *on: F.pmod(F.xxhash64(*on), count(counts)).cast("int")
    left = codes.where(F.col("_cell").isin(list(visitors))).withColumn("_block", one(blocks, *ids)).withColumn("_group", every(groups))
    right = visits.withColumn("_block", every(blocks)).withColumn("_group", one(groups, query_id))
    key = ["_cell", "_block", "_group"]
    near_schema = ST.StructType([asked.schema[query_id], *[codes.schema[c] for c in ids], ST.StructField("_cell", ST.IntegerType()), ST.StructField("_near", ST.DoubleType())])

    def meet(rows: pa.Table, who: pa.Table) -> pa.Table:
        if not rows.num_rows or not who.num_rows:
            return nothing(rows, who)
        coded = np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
        places = coded.astype(np.int64) + WORDS * np.arange(coded.shape[1])
        points = geometry.points(Vectors(who.column("_asked"), dim), queries=True)[:, :dim]
        base = points @ pivots[rows.column("_cell")[0].as_py()][:dim]
        chosen_rows, chosen_queries, scores = [], [], []
        rough = _rough(book.decode(coded))
        for at in range(0, who.num_rows, AT_ONCE):
            asked_points = points[at:at + AT_ONCE]
            short = None if rough is None else _short(asked_points, rough, rows.num_rows, most)
            if short is None:
                short = np.divmod(np.arange(len(asked_points) * rows.num_rows), rows.num_rows)
            tables = book.tables(asked_points).reshape(len(asked_points), -1)
            for q, start, end in _runs(short[0]):
                cols = short[1][start:end]
                near = tables[q][places[cols]].sum(axis=1) + base[at + q]
                best = np.argpartition(-near, most - 1)[:most] if len(near) > most else np.arange(len(near))
                chosen_rows.append(cols[best])
                chosen_queries.append(np.full(len(best), at + q))
                scores.append(near[best])
        taken = rows.take(pa.array(np.concatenate(chosen_rows)))
        asked_ids = who.column(query_id).take(pa.array(np.concatenate(chosen_queries)))
        return pa.table([asked_ids, *[taken.column(c) for c in ids], taken.column("_cell"), pa.array(np.concatenate(scores))],
                        names=[query_id, *ids, "_cell", "_near"])

    def nothing(rows: pa.Table, who: pa.Table) -> pa.Table:
        empty = rows.slice(0, 0)
        return pa.table([who.column(query_id).slice(0, 0), *[empty.column(c) for c in ids], pa.array([], pa.int32()), pa.array([], pa.float64())],
                        names=[query_id, *ids, "_cell", "_near"])

    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, near_schema)
    place = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("_near"), *ids))
    survivors = stage(near.withColumn("_place", place).where(F.col("_place") <= most).select(query_id, *[F.col(c).alias(f"_id_{c}") for c in ids], F.col("_cell").alias("_at")), "quantized-survivors")

    same = F.col("_cell") == F.col("_at")
    for c in ids:
        same = same & (F.col(c) == F.col(f"_id_{c}"))
    met = survivors.join(table.rows.drop("_dist"), same).drop("_at", *[f"_id_{c}" for c in ids]).join(asked, query_id)
    payload = [c for c in table.rows.columns if c not in (vec, "_cell", "_dist")]
    schema = ST.StructType([asked.schema[query_id], *[table.rows.schema[c] for c in payload], ST.StructField("_score", ST.DoubleType())])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, who = Vectors(batch.column(vec), dim), Vectors(batch.column("_asked"), dim)
                found = pa.Table.from_batches([batch]).select([query_id, *payload])
                yield from found.append_column("_score", pa.array(paired(who.matrix, rows.matrix, metric))).to_batches()

    best = Window.partitionBy(query_id).orderBy(F.desc("_score"), *ids)
    ranked = met.select(query_id, *payload, vec, "_asked").mapInArrow(exact, schema).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(query_id, *payload, (F.col("_score") / GRID).alias("score"), "rank")
