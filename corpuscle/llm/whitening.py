"""Whitening by principal components, each distinct vector fitted and projected once.

Vectors are rounded to whole numbers x and grouped by them.  The covariance is that of
the distinct x, each with weight one or with the number of its rows.  It is a sum of
products of centred matrices, one per batch of rows, weighted row by row; centring comes
before multiplying and starts from whole numbers, so nothing is lost to the size of
the entries.  Whitened vectors are worked out once per distinct x and joined back.

Dimensions bound what the driver sees: sums per dimension and one matrix of dimension
by dimension, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.session import stage

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 34  # larger entries count as not finite
COMPONENTS = 16


@dataclass(frozen=True)
class Whitening:
    n: int  # sum of the weights
    sums: tuple[int, ...]  # per dimension, exact
    values: np.ndarray  # variances along the components kept, falling
    vectors: np.ndarray  # their directions, one column each
    trace: float


def _rows(column: pa.Array, kind: str = "<i8") -> np.ndarray:
    """A matrix from a column of equally long byte strings."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=kind)


def rounded(batches: Iterator[pa.RecordBatch], scale: int = SCALE, offset: int = OFFSET) -> Iterator[pa.RecordBatch]:
    """Bytes of x for each vector whose entries are all there and finite; other rows are left out."""
    for batch in batches:
        lists = batch.column("v")
        lists = lists.cast(pa.large_list(pa.float64())) if not pa.types.is_large_list(lists.type) else lists
        keys, found = [], []
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)  # nulls become NaN
        there = lists.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore", over="ignore"):
            good = np.abs(flat) <= LARGEST
            flat = np.floor(flat * scale)
        for i in range(len(lists)):
            a, b = ends[i], ends[i + 1]
            if there[i] and b > a and good[a:b].all():
                keys.append(i)
                found.append((flat[a:b].astype("<i8") + offset).tobytes())
        kept = batch.select([c for c in batch.schema.names if c != "v"]).take(pa.array(keys, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, pa.binary())], names=[*kept.schema.names, "x"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight and weighted sums of x of one task, exact."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x, w = _rows(batch.column("x")), batch.column("w").to_pylist()
            if sum(w) * int(np.abs(x).max()) < 2**62:
                part = (x * np.array(w, dtype=np.int64)[:, None]).sum(axis=0).tolist()
            else:
                part = [sum(a * b for a, b in zip(column, w)) for column in x.T.tolist()]
            total = part if total is None else [a + b for a, b in zip(total, part)]
            n += sum(w)
    if total is not None:
        rows = [(-1, n), *enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in rows], pa.int32()), pa.array([Decimal(v) for _, v in rows], pa.decimal128(38, 0))],
            names=["dim", "total"],
        )


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n to full precision: the whole part of the mean comes off in whole numbers."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _gram(batches: Iterator[pa.RecordBatch], centred: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Weighted products of the centred rows of one task, a row of the matrix each."""
    total = None
    for batch in batches:
        if batch.num_rows:
            y = centred(batch)
            part = (y * batch.column("w").to_numpy(zero_copy_only=False).astype(np.float64)[:, None]).T @ y
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["dim", "products"]
        )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal rows of several tasks' matrices, in whatever order they come."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, row in zip(batch.column("dim").to_pylist(), batch.column("products")):
            values = np.asarray(row.values)
            held[dim] = held[dim] + values if dim in held else values
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["dim", "products"]
        )


def covariance(rows: DataFrame, centred: Callable[[pa.RecordBatch], np.ndarray], n: int) -> np.ndarray:
    """Covariance with divisor ``n``: products in the tasks, their rows added by dimension."""
    kind = "dim int, products array<double>"
    parts = rows.mapInArrow(lambda b: _gram(b, centred), kind).repartition("dim").mapInArrow(_added, kind)
    found = {r["dim"]: r["products"] for r in parts.collect()}
    return np.array([found[i] for i in range(len(found))]) / n


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows (x, w); none without rows.

    Directions whose variance is not told apart from rounding cannot be whitened: at most
    ``components`` of the others are kept, by falling variance.
    """
    totals = {r["dim"]: int(r["total"]) for r in distinct.mapInArrow(_sums, "dim int, total decimal(38,0)")
              .groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    if not totals:
        return None
    n, sums = totals.pop(-1), tuple(totals[d] for d in range(len(totals)))
    matrix = covariance(distinct, lambda b: _centred(_rows(b.column("x")), n, sums), n)
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values > max(values[0], 0) * len(sums) * np.finfo(float).eps * 16).sum())
    keep = min(components, real)
    return Whitening(n, sums, values[:keep].copy(), vectors[:, :keep].copy(), float(np.trace(matrix)))


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    turn = model.vectors / np.sqrt(model.values)
    whole = np.array([s // model.n for s in model.sums], dtype=np.int64)
    rest = np.array([s % model.n for s in model.sums], dtype=object)
    for batch in batches:
        x = _rows(batch.column("x"))
        z = _centred(x, model.n, model.sums) @ turn if len(x) else np.zeros((0, turn.shape[1]))
        apart = x - whole if len(x) else x
        # n * x - sums = n * (x - whole) - rest, in 64 bits where these suffice
        if len(x) and (model.n * (int(np.abs(apart).max()) + 1)) ** 2 * len(whole) < 2**62:
            far = ((model.n * apart - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        else:
            far = [sum((model.n * a - r) ** 2 for a, r in zip(row, rest)) for row in apart.tolist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), batch.column("w"), pa.array([Decimal(f) for f in far], pa.decimal128(38, 0)),
             pa.array(list(z), pa.list_(pa.float64()))], names=["digest", "w", "deviation", "whitened"],
        )


def _identity_error(rows: DataFrame, n: int, size: int) -> float:
    """Largest entry of the covariance of the whitened vectors minus the identity."""
    values = lambda b: np.array(b.column("whitened").to_pylist()).reshape(b.num_rows, size)
    means = rows.select(*[F.sum(F.col("w") * F.col("whitened")[k]).alias(str(k)) for k in range(size)]).first()
    mean = np.array(means, dtype=np.float64) / n
    return float(np.abs(covariance(rows, lambda b: values(b) - mean, n) - np.eye(size)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, counted: bool = False) -> DataFrame:
    """A row per row of ``vectors`` and component: ``key``, ``component`` from 1, ``n``,
    ``deviation`` (decimal, exact), ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null, empty, or holds entries that are null, not finite or beyond
    2^34 take no part; neither do vectors shorter than the longest.  Components without
    variance are left out, so a single distinct vector or an empty table gives no rows.
    With ``counted`` a distinct vector weighs as many as its rows, else one.  Rows with
    equal or null keys each get their answer.  Copies are counted where they are read;
    the join back is of two plain shuffles, which Spark splits if a third of the rows
    share one vector.  Other columns are ignored.
    """
    kind = vectors.select(F.col(f"`{key}`").alias("k")).schema["k"].dataType
    source = vectors.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    size = source.where(f"forall(v, c -> c IS NOT NULL AND abs(c) <= {LARGEST})").agg(F.max(F.size("v"))).first()[0] or 0
    rows = source.mapInArrow(rounded, f"k {kind.simpleString()}, x binary").where(F.length("x") == 8 * size)
    counts = rows.groupBy("x").agg(F.count("*").alias("n")) if counted else rows.groupBy("x").agg(F.lit(1).cast("long").alias("n"))
    distinct = stage(counts.select("x", F.col("n").alias("w"), F.unhex(F.sha2("x", 256)).alias("digest")), "distinct-vectors")
    model = fit(distinct, components)
    keep = 0 if model is None else len(model.values)
    if not keep:
        empty = f"`{key}` {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    once = stage(distinct.mapInArrow(
        lambda b: _whitened(b, model), "digest binary, w long, deviation decimal(38,0), whitened array<double>"), "whitened-vectors")
    error = _identity_error(once, model.n, keep)
    keyed = stage(rows.select("k", F.unhex(F.sha2("x", 256)).alias("digest")), "vector-digests")
    joined = keyed.join(once, "digest").select("k", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return joined.select(
        F.col("k").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
