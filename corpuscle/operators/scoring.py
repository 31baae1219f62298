"""Scoring of Arrow blocks of vectors: the part of the search that runs inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

METRICS = ("cosine", "cosine_strict", "euclidean", "dot")

# Scores are compared on this grid: the last bits of a matrix product depend on
# the position in the block, and equal vectors must tie wherever they lie.
GRID = 1e9
_ENTRIES = 250_000  # of one score matrix: 2 MB, so that the passes over it stay in cache
_ROUGH = 500_000  # of one matrix of rough scores, in single precision
KEPT_BYTES = 16 << 20  # of hits, texts included, that are kept without looking which are still among the best
STRIPES = 32  # columns of rough scores of which only the largest is looked at for a bound


class Vectors:
    """Vectors of one block as a matrix of ``dim`` columns.

    Shorter vectors are padded with zeros, longer ones cut, which leaves the
    dot product over the common prefix.  Norms and their squares are those of
    the full vectors.  ``finite`` marks the vectors that take part in a search:
    those whose squares sum to a finite number, which neither a null element nor
    one that is no finite number does.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, dim: int | None = None):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
        self.sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        self.dim = int(self.sizes.max(initial=0)) if dim is None else dim
        if np.all(self.sizes == self.dim):
            self.matrix = values.reshape(len(self.sizes), self.dim)
            self.squares = np.einsum("ij,ij->i", self.matrix, self.matrix)
            self._finish()
            return
        self.matrix = np.zeros((len(self.sizes), self.dim))
        self.squares = np.zeros(len(self.sizes))
        starts = np.cumsum(self.sizes) - self.sizes
        for size in np.unique(self.sizes[self.sizes > 0]):
            rows = np.flatnonzero(self.sizes == size)
            full = values[starts[rows][:, None] + np.arange(size)]
            width = min(int(size), self.dim)
            self.matrix[rows, :width] = full[:, :width]
            self.squares[rows] = np.einsum("ij,ij->i", full, full)
        self._finish()

    def _finish(self) -> None:
        self.finite = np.isfinite(self.squares)
        self.norms = np.sqrt(self.squares)


def finite_rows(table: pa.Table, vec: str) -> pa.Table:
    """The rows whose vector can take part."""
    finite = Vectors(table.column(vec), 0).finite
    return table if finite.all() else table.filter(pa.array(finite))


def directions(vectors: Vectors) -> np.ndarray | None:
    """The vectors over their norms in single precision, zero where there is no norm; none where norms are extreme."""
    norms = np.where(vectors.norms > 0, vectors.norms, 1.0)
    if len(norms) and not (1e-100 < norms.min() and norms.max() < 1e100):
        return None
    return (vectors.matrix / norms[:, None]).astype(np.float32)


def striped(block: np.ndarray) -> np.ndarray:
    """``block`` for ``shortlist``: as many rows as stripes divide, the last ones rows of the same column of stripes again."""
    n = len(block)
    more = -n % STRIPES
    first = n - (n + more) // STRIPES
    return np.concatenate([block, block[first:first + more]])


def shortlist(queries: np.ndarray, block: np.ndarray, n: int, k: int, low: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Row and column of all entries of the product that can be among the ``k`` largest of their row; none if they are many.

    ``block`` is ``striped`` and has ``n`` rows.  Rows of both sides are in single precision and at most of norm
    one, so an entry is off by less than ``margin``.  The k-th largest of the stripes' maxima is reached by k different
    entries, so smaller ones, by twice the margin and ``slack``, are out, as are those below ``low``.
    """
    s = queries @ block.T
    margin = (queries.shape[1] + 8) * 1.2e-7
    bound = low - slack - margin
    heads = s.reshape(len(s), STRIPES, -1).max(axis=1)
    if heads.shape[1] >= k:
        kth = np.partition(heads, heads.shape[1] - k, axis=1)[:, heads.shape[1] - k]
        bound = np.maximum(bound, kth - 2 * margin - slack)
    flat = np.flatnonzero(s >= bound.astype(np.float32)[:, None])
    if len(flat) > s.size // 8:
        return None
    rows, cols = np.divmod(flat, s.shape[1])
    real = cols < n
    return rows[real], cols[real]


def score(queries: Vectors, part: slice, block: Vectors, metric: str) -> np.ndarray:
    """Scores of a part of the queries against every row of the block, on the grid."""
    if metric == "euclidean" and not np.all(block.sizes == block.dim):
        raise ValueError(f"euclidean search needs vectors of {block.dim} dimensions")
    s = queries.matrix[part] @ block.matrix.T
    if metric == "euclidean":
        squares = queries.squares[part, None] + block.squares[None, :]
        s = 1.0 / (1.0 + np.maximum(squares - 2.0 * s, 0.0))
    elif metric != "dot":
        scale = queries.norms[part, None] * block.norms[None, :]
        undirected = scale == 0
        scale[undirected] = 1.0
        s /= scale
        s[undirected] = 0.0
        if metric == "cosine_strict":
            s[:, block.sizes != block.dim] = 0.0
    s *= GRID
    s += 0.5
    return np.floor(s, out=s)


def paired(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """Cosine or dot product of each row of ``x`` with the same row of ``y``, on the grid."""
    s = np.einsum("ij,ij->i", x, y)
    if metric != "dot":
        scale = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        s = np.where(scale > 0, s / np.where(scale > 0, scale, 1.0), 0.0)
    return np.floor(s * GRID + 0.5)


def best_per_row(s: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest entries per row, none below ``floor``.

    Among equal entries the leftmost wins.  ``floor`` is raised in place to the
    k-th entry of the rows that have as many.
    """
    n = s.shape[1]
    mask = s >= floor[:, None]
    crowded = np.flatnonzero(mask.sum(axis=1) > k)
    if len(crowded):
        part = s[crowded]
        kth = np.partition(part, n - k, axis=1)[:, n - k]
        keep, ties = part > kth[:, None], part == kth[:, None]
        room = k - keep.sum(axis=1)
        if np.any(ties.sum(axis=1) > room):
            ties &= np.cumsum(ties, axis=1, dtype=np.int32) <= room[:, None]
        mask[crowded] = keep | ties
        floor[crowded] = kth
    return np.nonzero(mask)


class Block:
    """Rows of a corpus made ready to be scored: those that take part, in the order of their ids."""

    def __init__(self, rows: pa.Table, vec: str, ids: list[str], dim: int):
        rows = finite_rows(rows, vec)
        if ids and rows.num_rows:
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ids]))
        self.num_rows = rows.num_rows
        self.vectors = Vectors(rows.column(vec), dim)
        self.payload = rows.drop_columns([vec])
        self._rough: dict[str, tuple[np.ndarray, float] | None] = {}

    def rough(self, metric: str) -> tuple[np.ndarray, float] | None:
        """The rows for ``shortlist`` and what their products are scaled by; none where it does not apply."""
        if metric not in self._rough:
            self._rough[metric] = self._roughly(metric)
        return self._rough[metric]

    def _roughly(self, metric: str) -> tuple[np.ndarray, float] | None:
        if metric == "euclidean" or self.num_rows < STRIPES ** 2:
            return None
        if metric != "dot":
            unit = directions(self.vectors)
            if unit is not None and metric == "cosine_strict":
                unit[self.vectors.sizes != self.vectors.dim] = 0.0
            return None if unit is None else (striped(unit), 1.0)
        most = float(self.vectors.norms.max())
        if not 1e-100 < most < 1e100:
            return None
        return striped((self.vectors.matrix / most).astype(np.float32)), most


class Winners:
    """Running top ``k`` of every query over the blocks one task sees.

    ``floor`` holds, per query, a score below which rows are of no interest.
    Memory stays at a few times ``queries x k`` rows however many blocks come.  Large
    blocks are first scored roughly, and exactly only where that leaves a doubt.
    """

    def __init__(self, queries: Vectors, k: int, metric: str, ids: list[str], floor: np.ndarray | None = None):
        self.queries, self.k, self.metric, self.ids = queries, k, metric, ids
        self.floor = np.full(len(queries.sizes), -np.inf) if floor is None else floor.copy()
        self.kept: list[pa.Table] = []
        self.rows = 0
        self.limit = max(4 * k * len(queries.sizes), 50_000)
        self.bytes = self.compacted = 0
        self._unit: np.ndarray | None = None

    def offer(self, block: pa.Table, vec: str) -> None:
        """Score the rows of a block; equal scores are ranked by the id columns."""
        self.meet(Block(block, vec, self.ids, self.queries.dim))

    def meet(self, block: Block) -> None:
        if block.num_rows == 0 or len(self.floor) == 0:
            return
        rough = block.rough(self.metric)
        if rough is not None and self._unit is None:
            self._unit = directions(self.queries)
        fast = rough is not None and self._unit is not None
        step = max(1, (_ROUGH if fast else _ENTRIES) // block.num_rows)
        chosen = []
        for at in range(0, len(self.floor), step):
            part = slice(at, min(at + step, len(self.floor)))
            found = self._short(block, part, *rough) if fast else None
            if found is None:
                found = self._whole(block, part)
            chosen.append(found)
        rows, cols, scores = (np.concatenate(parts) for parts in zip(*chosen))
        found = block.payload.take(pa.array(cols)).append_column("_query", pa.array(rows, pa.int64()))
        self.kept.append(found.append_column("_score", pa.array(scores)))
        self.rows += found.num_rows
        self.bytes += self.kept[-1].nbytes
        if self.rows > self.limit or (self.bytes > KEPT_BYTES and self.rows > 2 * self.compacted):
            self._compact()

    def _whole(self, block: Block, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best rows of a part of the queries, from all of their scores."""
        chosen = []
        step = max(1, _ENTRIES // block.num_rows)
        for at in range(part.start, part.stop, step):
            few = slice(at, min(at + step, part.stop))
            s = score(self.queries, few, block.vectors, self.metric)
            rows, cols = best_per_row(s, self.k, self.floor[few])
            chosen.append((rows + at, cols, s[rows, cols]))
        return tuple(np.concatenate(parts) for parts in zip(*chosen))

    def _short(self, block: Block, part: slice, rough: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The same rows, with scores worked out for those alone that a rough score does not rule out."""
        scale = most * self.queries.norms[part] if self.metric == "dot" else np.ones(part.stop - part.start)
        if not scale.all():
            return None
        near = shortlist(self._unit[part], rough, block.num_rows, self.k, (self.floor[part] - 1.0) / GRID / scale, 2.0 / GRID / scale)
        if near is None:
            return None
        rows, cols = near[0] + part.start, near[1]
        s = self._paired(block.vectors, rows, cols)
        order = np.lexsort((cols, -s, rows))
        rows, cols, s = rows[order], cols[order], s[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = (rank < self.k) & (s >= self.floor[rows])
        last = keep & (rank == self.k - 1)
        self.floor[rows[last]] = s[last]
        return rows[keep], cols[keep], s[keep]

    def _paired(self, block: Vectors, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """``score`` of single pairs."""
        s = np.concatenate([
            np.einsum("ij,ij->i", self.queries.matrix[rows[at:at + 10_000]], block.matrix[cols[at:at + 10_000]])
            for at in range(0, max(len(rows), 1), 10_000)
        ])
        if self.metric != "dot":
            scale = self.queries.norms[rows] * block.norms[cols]
            s = np.where(scale == 0, 0.0, s / np.where(scale == 0, 1.0, scale))
            if self.metric == "cosine_strict":
                s[block.sizes[cols] != block.dim] = 0.0
        return np.floor(s * GRID + 0.5)

    def _compact(self) -> None:
        pool = pa.concat_tables(self.kept)
        keys = [("_query", "ascending"), ("_score", "descending")] + [(c, "ascending") for c in self.ids]
        pool = pool.take(pc.sort_indices(pool, sort_keys=keys))
        groups = pool.column("_query").to_numpy()
        rank = np.arange(len(groups)) - np.searchsorted(groups, groups)
        last = np.flatnonzero(rank == self.k - 1)
        self.floor[groups[last]] = pool.column("_score").to_numpy()[last]
        pool = pool.filter(pa.array(rank < self.k))
        self.kept, self.rows, self.bytes, self.compacted = [pool], pool.num_rows, pool.nbytes, pool.num_rows
        self.limit = max(self.limit, 2 * self.rows)

    def result(self) -> pa.Table | None:
        if not self.rows:
            return None
        self._compact()
        return self.kept[0]
