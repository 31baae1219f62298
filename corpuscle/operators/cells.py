"""A corpus of vectors split into cells around pivots, for search that visits few of them.

The split is a plain Parquet table with the cell of every row, next to one row
per cell that holds its pivot, row count and radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpuscle.operators.scoring import GRID, METRICS, Vectors, finite_rows
from corpuscle.session import fresh_path

_SLACK = 1e-6  # widens every bound against rounding
MOST_CELLS = 4096


@dataclass(frozen=True)
class Geometry:
    """Maps vectors to points whose distances bound the scores.

    For cosine the points are unit vectors.  Extra coordinates keep a vector
    without direction at right angles to every query, and hold what lies beyond
    the query dimension, so that the dot product of two points is the score.
    """

    metric: str
    dim: int

    @property
    def width(self) -> int:
        """Coordinates of a point."""
        return self.dim if self.metric in ("euclidean", "dot") else self.dim + 3

    def points(self, vectors: Vectors, queries: bool = False) -> np.ndarray:
        if self.metric == "euclidean" and not np.all(vectors.sizes == self.dim):
            raise ValueError(f"euclidean search needs vectors of {self.dim} dimensions")
        if self.metric in ("euclidean", "dot"):
            return vectors.matrix
        usable = vectors.norms > 0
        if self.metric == "cosine_strict":
            usable &= vectors.sizes == self.dim
        out = np.zeros((len(vectors.sizes), self.width))
        out[usable, : self.dim] = vectors.matrix[usable] / vectors.norms[usable, None]
        beyond = 1.0 - np.einsum("ij,ij->i", out, out)
        out[usable, self.dim] = np.sqrt(np.maximum(beyond[usable], 0.0))
        out[~usable, self.dim + (1 if queries else 2)] = 1.0
        if queries:
            out[usable, self.dim] = 0.0
        return out

    def upper_bounds(self, points: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """No row of a cell scores higher against the query than this."""
        gap = np.maximum(distances(points, pivots) - radius[None, :] - _SLACK, 0.0)
        if self.metric == "euclidean":
            return 1.0 / (1.0 + gap**2) + _SLACK
        length = np.sqrt(np.einsum("ij,ij->i", points, points))
        by_dot = points @ pivots.T + length[:, None] * (radius[None, :] + _SLACK) + _SLACK
        if self.metric == "dot":
            return by_dot
        return np.minimum(by_dot, 1.0 - gap**2 / 2.0 + _SLACK)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", pivots, pivots)
    return np.sqrt(np.maximum(squares - 2.0 * points @ pivots.T, 0.0))


def nearest_first(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Pivots of every point by distance; equal on the grid means lower number first."""
    return np.argsort(np.floor(distances(points, pivots) * GRID + 0.5), axis=1, kind="stable")


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` points, each the farthest from those taken before it."""
    chosen = [0]
    gap = distances(points, points[:1])[:, 0]
    while len(chosen) < n and gap.max() > _SLACK:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


@dataclass(frozen=True)
class CellTable:
    """The split corpus: ``rows`` with ``_cell`` and ``_dist``, and arrays over the cells."""

    rows: DataFrame
    pivots: np.ndarray
    counts: np.ndarray
    radius: np.ndarray
    geometry: Geometry
    ids: list[str]
    vec: str


def build_cells(
    corpus: DataFrame,
    path: str,
    ids: list[str],
    vec: str = "vec",
    metric: str = "cosine",
    cells: int | None = None,
    dim: int | None = None,
    apart: bool = False,
    by_cell: bool = True,
) -> CellTable:
    """Split a corpus and write it below ``path``; rows without a finite vector are left out.

    ``cells`` is their number, by default the root of the number of rows, so that
    cells and their contents grow alike; pivots are compared on the driver, which
    bounds that default to ``MOST_CELLS``.  ``dim`` is the dimension of the queries to come, by default the largest in
    the corpus.  ``apart`` picks pivots far from each other, which suits exact
    search, instead of cells of like size.  ``by_cell`` gives every cell a
    directory, so that a search reads only the cells it visits.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark = corpus.sparkSession
    corpus = corpus.where(F.col(vec).isNotNull())
    if dim is None:
        dim = corpus.agg(F.max(F.size(vec))).first()[0] or 0
    if cells is None:
        cells = min(max(1, round(corpus.count() ** 0.5)), MOST_CELLS)
    geometry = Geometry(metric, dim)
    pivots = _choose_pivots(corpus, geometry, ids, vec, cells, apart)
    split = _with_cell(corpus, geometry, pivots, vec)
    if by_cell:
        split.hint("rebalance", "_cell").write.partitionBy("_cell").parquet(f"{path}/rows")
    else:
        split.write.parquet(f"{path}/rows")
    stats = spark.read.schema(split.schema).parquet(f"{path}/rows").groupBy("_cell").agg(
        F.count("*").alias("n"), F.max("_dist").alias("radius")
    )
    # At most one row per cell passes through the driver, here and in open_cells.
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(pivots)]
    listed = spark.createDataFrame(rows, "_cell int, pivot array<double>").join(stats, "_cell", "left")
    listed.select(
        "_cell", "pivot", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("radius", F.lit(0.0)).alias("radius"),
        F.lit(metric).alias("metric"), F.lit(dim).alias("dim"), F.lit(vec).alias("vec"),
        F.array(*[F.lit(c) for c in ids]).alias("ids"),
    ).coalesce(1).write.parquet(f"{path}/cells")
    rows = spark.read.schema(split.schema).parquet(f"{path}/rows")
    return _cell_table(spark, path, rows, geometry, ids, vec)


def open_cells(spark: SparkSession, path: str) -> CellTable:
    """The split corpus written below ``path``."""
    kind = spark.read.parquet(f"{path}/cells").select("metric", "dim", "ids", "vec").first()
    if kind is None:
        raise ValueError(f"the corpus split at {path} was empty")
    rows = spark.read.parquet(f"{path}/rows")
    return _cell_table(spark, path, rows, Geometry(kind.metric, kind.dim), kind.ids, kind.vec)


def _cell_table(
    spark: SparkSession, path: str, rows: DataFrame, geometry: Geometry, ids: list[str], vec: str
) -> CellTable:
    cells = spark.read.parquet(f"{path}/cells").orderBy("_cell").collect()
    pivots = np.array([row.pivot for row in cells]).reshape(len(cells), geometry.width)
    counts = np.array([row.n for row in cells], dtype=np.int64)
    radius = np.array([row.radius for row in cells], dtype=np.float64)
    return CellTable(rows, pivots, counts, radius, geometry, ids, vec)


def temporary_cells(
    corpus: DataFrame, ids: list[str], vec: str, metric: str, cells: int | None, dim: int, apart: bool
) -> CellTable:
    """A split for one search, in the shared folder, in the order the corpus came."""
    path = fresh_path(corpus.sparkSession, "search-cells")
    return build_cells(corpus, path, ids, vec, metric, cells, dim, apart, by_cell=False)


def _choose_pivots(
    corpus: DataFrame, geometry: Geometry, ids: list[str], vec: str, cells: int, apart: bool
) -> np.ndarray:
    """Distinct vectors among the rows that come first by the hash of their ids.

    ``apart`` takes those that lie far from each other, which keeps the
    cells narrow and their bounds tight; otherwise the first ones, which
    makes cells of like size.  Any choice gives right results.
    """
    mixed = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ids]))
    head = corpus.select(mixed.alias("_order"), vec).orderBy("_order").limit(4 * cells).toArrow()
    head = finite_rows(head, vec)
    points = geometry.points(Vectors(head.column(vec), geometry.dim))
    if not len(points):
        return points
    _, first = np.unique(points, axis=0, return_index=True)
    points = points[np.sort(first)]
    return far_apart(points, cells) if apart else points[:cells]


def _with_cell(corpus: DataFrame, geometry: Geometry, pivots: np.ndarray, vec: str) -> DataFrame:
    schema = ST.StructType(
        corpus.schema.fields
        + [ST.StructField("_cell", ST.IntegerType()), ST.StructField("_dist", ST.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = finite_rows(pa.Table.from_batches([batch]), vec)
            if not rows.num_rows:
                continue
            points = geometry.points(Vectors(rows.column(vec), geometry.dim))
            cell = nearest_first(points, pivots)[:, 0]
            away = distances(points, pivots)[np.arange(len(cell)), cell]
            yield from rows.append_column("_cell", pa.array(cell.astype(np.int32))).append_column(
                "_dist", pa.array(away)).to_batches()

    return corpus.mapInArrow(run, schema)
