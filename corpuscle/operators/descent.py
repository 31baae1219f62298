"""Neighbour graphs by neighbour descent: neighbours of neighbours are likely neighbours.

Every row starts with the best of a few small blocks of rows that lie on the same side
of many random planes.  Then, in rounds, each row introduces to one another the rows it
lists and the rows that list it, a bounded sample of either, of which at least one was
not introduced before; whoever finds a better neighbour takes it.  It ends when hardly an
edge changes.  So a row is compared with a number of others that does not grow with the
table, where brute force compares it with all.

Equal vectors are one node with their smallest ids, so that copies, whatever share of the
rows they are, cost nothing and cannot fill each other's lists.  A node listed by very many
passes on a sample of them, picked where they lie.  Rounds are written to the shared
folder; the driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscle.functions.vectors import is_finite
from corpuscle.operators.scoring import GRID, paired
from corpuscle.session import stage

PLANES = 48  # bits by which rows are ordered for a start
EDGES = "u long, v long, s float"


@dataclass
class Descent:
    """The graph, what was introduced in each round, and how many edges changed."""

    edges: DataFrame
    nodes: int
    begun: int  # pairs compared before the first round
    lists: list[DataFrame] = field(default_factory=list)
    changed: list[int] = field(default_factory=list)

    def compared_per_node(self) -> float:
        """Pairs compared in all rounds, for each node."""
        pairs = self.begun
        for lists in self.lists:
            sizes = lists.groupBy("x").agg(F.count_if("fresh").alias("n"), F.count_if(~F.col("fresh")).alias("o"))
            pairs += sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2 + F.col("n") * F.col("o"))).first()[0] or 0
        return pairs / max(self.nodes, 1)


def _matrix(column: pa.Array, kind: str = "<f4") -> np.ndarray:
    """A matrix from a column of equally long byte strings."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [v.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes() for v in batch.column("vec")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary())], names=["id", "raw"])


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the unit vectors; a vector without direction stays as it is."""
    for batch in batches:
        rows = _matrix(batch.column("raw"), "<f8")
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        units = (rows / np.where(norms > 0, norms, 1.0)[:, None]).astype("<f4")
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([u.tobytes() for u in units], pa.binary())], names=["node", "unit"])


def _side(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Which side of random planes a row lies on, as a number whose order keeps close rows close."""
    planes = None
    for batch in batches:
        rows = _matrix(batch.column("unit"))
        if not len(rows):
            continue
        if planes is None:
            planes = np.random.default_rng(seed).normal(size=(rows.shape[1], PLANES)).astype(np.float32)
        bits = (rows @ planes > 0).astype(np.int64)
        turned = np.bitwise_xor.accumulate(bits, axis=1)  # Gray code: neighbours in order differ in one side
        code = turned @ (np.int64(1) << np.arange(PLANES - 1, -1, -1, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("unit"), pa.array(code)], names=["node", "unit", "code"])


def _best_of_block(nodes: np.ndarray, rows: np.ndarray, keep: int) -> pa.RecordBatch:
    s = rows @ rows.T
    np.fill_diagonal(s, -np.inf)
    n = min(keep, len(nodes) - 1)
    best = np.argpartition(-s, n - 1, axis=1)[:, :n]
    at = np.repeat(np.arange(len(nodes)), n)
    flat = best.ravel()
    return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[flat]), pa.array(s[at, flat].astype(np.float32))], names=["u", "v", "s"])


def _blocks(batches: Iterator[pa.RecordBatch], size: int, keep: int) -> Iterator[pa.RecordBatch]:
    """The best neighbours within blocks of consecutive rows; batches are cut evenly."""
    for batch in batches:
        nodes, rows = batch.column("node").to_numpy(), _matrix(batch.column("unit"))
        for part in np.array_split(np.arange(len(nodes)), max(1, -(-len(nodes) // size))):
            if len(part) > 1:
                yield _best_of_block(nodes[part], rows[part], keep)


def _introduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Better neighbours found among the rows each ``x`` lists; rows come sorted by ``x``.

    What one ``x`` lists is bounded, so it is held whole, across batches.
    """
    held: pa.Table | None = None

    def meet(table: pa.Table) -> pa.RecordBatch:
        x, c = table.column("x").to_numpy(), table.column("c").to_numpy()
        fresh, kth = table.column("fresh").to_numpy(), table.column("kth").to_numpy()
        rows = _matrix(table.column("unit").combine_chunks())
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            s = rows[a:b] @ rows[a:b].T
            good = (fresh[a:b, None] | fresh[None, a:b]) & (s > kth[a:b, None])
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            out.append((c[a + i], c[a + j], s[i, j]))
        u, v, s = (np.concatenate(p) for p in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s.astype(np.float32))], names=["u", "v", "s"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        x = table.column("x").to_numpy()
        whole = int(np.searchsorted(x, x[-1]))
        held = table.slice(whole)
        if whole:
            yield meet(table.slice(0, whole))
    if held is not None and held.num_rows:
        yield meet(held)


def _rank(by: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))


def _kept(edges: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` edges of each node; of an edge found twice the older state counts."""
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"), F.min("born").alias("born"))
    return once.withColumn("r", _rank(["u"], F.desc("s"), F.col("v"))).where(F.col("r") <= keep).drop("r")


def descend(
    nodes: DataFrame, keep: int, sample: int = 14, trees: int = 4, block: int = 64, rounds: int = 15, settled: float = 0.002, seed: int = 7,
) -> Descent:
    """Edges (u, v, s) to about the ``keep`` nearest of every row of (node, unit).

    ``unit`` holds the bytes of unit vectors of one length, ``node`` is unique.  It ends when
    less than the share ``settled`` of all edges is new, or after ``rounds``.
    """
    start = None
    for tree in range(trees):
        sided = nodes.mapInArrow(lambda b, t=tree: _side(b, seed + t), "node long, unit binary, code long")
        found = sided.repartitionByRange("code", "node").sortWithinPartitions("code", "node").mapInArrow(
            lambda b: _blocks(b, block, keep), EDGES)
        start = found if start is None else start.union(found)
    begun = start.withColumn("fresh", F.lit(True)).withColumn("born", F.lit(0))
    edges = stage(_kept(begun, keep), "descent-start")
    count = nodes.count()
    result = Descent(edges, count, trees * block * count // 2)
    for number in range(1, rounds + 1):
        mixed = F.xxhash64("u", "v", F.lit(number))
        # What is introduced now is not fresh in the next round.
        ranked = edges.withColumn("r", _rank(["u", "fresh"], mixed, F.col("v")))
        listed = ranked.where(F.col("r") <= sample)
        turned = listed.select(F.col("v").alias("x"), F.col("u").alias("c"), "fresh", mixed.alias("m"))
        turned = turned.withColumn("r", _rank(["x", "fresh"], F.col("m"), F.col("c"))).where(F.col("r") <= sample)
        lists = listed.select(F.col("u").alias("x"), F.col("v").alias("c"), "fresh").union(turned.select("x", "c", "fresh"))
        lists = stage(lists.groupBy("x", "c").agg(F.max("fresh").alias("fresh")), "descent-lists")
        kth = edges.groupBy(F.col("u").alias("c")).agg(
            F.when(F.count("*") >= keep, F.min("s")).otherwise(F.lit(float("-inf")).cast("float")).alias("kth"))
        met = lists.join(kth, "c").join(nodes.withColumnRenamed("node", "c"), "c").select("x", "c", "fresh", "kth", "unit")
        found = met.repartition("x").sortWithinPartitions("x", "c").mapInArrow(_introduced, EDGES)
        found = found.groupBy("u", "v").agg(F.max("s").alias("s")).select("u", "v", "s", F.lit(True).alias("fresh"), F.lit(number).alias("born"))
        before = ranked.select("u", "v", "s", (F.col("fresh") & (F.col("r") > sample)).alias("fresh"), "born")
        edges = stage(_kept(before.union(found), keep), "descent-edges")
        result.edges = edges
        result.lists.append(lists)
        result.changed.append(edges.where(F.col("born") == number).count())
        if result.changed[-1] <= settled * keep * count:
            break
    return result


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cosines of two vectors in full precision, on the grid of exact search."""
    for batch in batches:
        scores = paired(_matrix(batch.column("a"), "<f8"), _matrix(batch.column("b"), "<f8"), "cosine")
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(scores)], names=["u", "v", "g"])


def knn_descent(
    embeddings: DataFrame, k: int = 10, token: str = "token", vec: str = "vec", keep: int | None = None, **options,
) -> tuple[DataFrame, Descent]:
    """Edges ``token, neighbor, cosine, rank`` to about the ``k`` nearest others, and how they were found.

    Approximate: a neighbour may be missing, but scores are exact and so is their order, ties
    by the neighbour's id.  ``keep`` edges are kept on the way, by default three times ``k``
    and 24 at least; other options are those of ``descend``.  Tokens must be unique.  Rows
    with a null token or without a finite vector are left out, as are vectors shorter than
    the longest.  A table of one row has no edges.
    """
    keep = keep or max(3 * k, 24)
    known = embeddings.select(F.col(token).alias("id"), F.col(vec).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & is_finite(F.col("vec")))
    kind = known.schema["id"].dataType.simpleString()
    size = known.agg(F.max(F.size("vec"))).first()[0] or 0
    packed = stage(known.where(F.size("vec") == size).mapInArrow(_packed, f"id {kind}, raw binary"), "descent-vectors")
    # Copies are counted where they are read; a node's number is written with it and stays.
    nodes = stage(packed.groupBy("raw").count().select(F.monotonically_increasing_id().alias("node"), "raw"), "descent-nodes")
    digest = F.sha2("raw", 256).alias("digest")
    members = stage(packed.select("id", digest).join(nodes.select("node", digest), "digest").select("id", "node"), "descent-members")
    units = stage(nodes.mapInArrow(_unit, "node long, unit binary"), "descent-units")
    found = descend(units, keep, **options)

    itself = nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))
    wanted = found.edges.select("u", "v").union(itself)
    paired = wanted.join(nodes.select(F.col("node").alias("u"), F.col("raw").alias("a")), "u").join(
        nodes.select(F.col("node").alias("v"), F.col("raw").alias("b")), "v")
    scored = paired.select("u", "v", "a", "b").mapInArrow(_scored, "u long, v long, g double")
    firsts = members.withColumn("r", _rank(["node"], F.col("id"))).where(F.col("r") <= k + 1).select(F.col("node").alias("v"), F.col("id").alias("neighbor"))
    # One more than asked for: a row may be among its own node's best.
    best = scored.join(firsts, "v").withColumn("r", _rank(["u"], F.desc("g"), F.col("neighbor"))).where(F.col("r") <= k + 1)
    best = stage(best.select(F.col("u").alias("node"), "neighbor", "g"), "descent-best")
    others = members.join(best, "node").where(~F.col("id").eqNullSafe(F.col("neighbor")))
    ranked = others.withColumn("rank", _rank(["id"], F.desc("g"), F.col("neighbor"))).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("token"), "neighbor", (F.col("g") / GRID).alias("cosine"), "rank"), found
