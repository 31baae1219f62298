"""Near-duplicates by SimHash, joined through the bit counts of their segments.

A fingerprint of 64 bits is mapped to the number of set bits in each of its 32
segments of two bits.  The Manhattan distance of two such count vectors never
exceeds the Hamming distance of the fingerprints.  The vectors are points of a
grid; cut into halves of 16 coordinates, two points at most three apart have a half
in which they are at most one apart.  So each point looks, in each half, into its
own cell and into the cells one step up along one coordinate, meets there all
points it may link to, and pairs are checked by the full Manhattan distance and
then by the exact Hamming distance.

Counts 0, 1, 2 are written 00, 01, 11, that is, the bits of a segment are sorted:
the Manhattan distance of two vectors is the bit count of the exclusive or.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import without
from corpuscle.llm.components import connected_components, sent
from corpuscle.session import stage

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BLOCK = 1 << 14

LOW_BITS = "6148914691236517205L"  # 0x5555555555555555


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash over the word shingles of a UTF-8 text, as an unsigned number."""
    words = text.lower().split()  # of bytes: A-Z, and space and \\x09-\\x0D
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    total, counts = 0, np.zeros(64, dtype=np.int64)
    while block := [digest(s, seed) for s in islice(shingles, BLOCK)]:
        bits = np.unpackbits(np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter(
            (fingerprint(t.as_py(), width, seed) for t in batch.column("text")), dtype=np.uint64, count=batch.num_rows
        )
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(marks.view(np.int64))], names=[*names, "fp"]
        )


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint ``fp`` as a signed long; null texts are empty, with fp 0."""
    own = without(docs, text, "fp")
    source = docs.select(
        *[F.col(f"`{c}`") for c in own.columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text")
    )
    return source.mapInArrow(lambda batches: _fingerprints(batches, width, seed), own.schema.add("fp", "long"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _cells(half: str, number: int) -> str:
    """Own cell and the cells one step up, as an array of (cell, own)."""
    return f"""transform(
        concat(array(-1), filter(sequence(0, 15), j -> (shiftright({half}, 2 * j + 1) & 1L) = 0)),
        j -> named_struct(
            'cell', {number << 32}L | CASE WHEN j < 0 THEN {half}
                WHEN (shiftright({half}, 2 * j) & 1L) = 0 THEN {half} | shiftleft(1L, 2 * j)
                ELSE {half} | shiftleft(2L, 2 * j) END,
            'own', j < 0))"""


def _points(marks: DataFrame, *names: str) -> DataFrame:
    """The fingerprints with the halves of their bit counts."""
    return marks.select("fp", *names).withColumn(
        "u", F.expr(f"((fp | shiftrightunsigned(fp, 1)) & {LOW_BITS})"
                    f" | shiftleft(fp & shiftrightunsigned(fp, 1) & {LOW_BITS}, 1)"),
    ).withColumn("h0", F.expr("u & 4294967295L")).withColumn("h1", F.expr("shiftrightunsigned(u, 32)"))


def _met(probes: DataFrame, stored: DataFrame, near: Column) -> DataFrame:
    """The join of points and those that look for them, by shuffles on both sides.

    Spark sizes either side without the cells an explode makes of a point, so left alone it
    sends tables to the driver that are up to 34 times as large as it takes them for.
    """
    return probes.hint("merge").join(stored, near)


def _stored(points: DataFrame, *names: str) -> DataFrame:
    return points.select("fp", "u", *names, F.explode(F.expr(f"array(h0, {1 << 32}L | h1)")).alias("cell"))


def _probes(points: DataFrame, *names: str) -> DataFrame:
    return points.select(
        F.col("fp").alias("fp2"), F.col("u").alias("u2"), *[F.col(n).alias(f"{n}2") for n in names],
        F.inline(F.expr(f"concat({_cells('h0', 0)}, {_cells('h1', 1)})")),
    )


NEAR = f"bit_count(u ^ u2) <= {MAX_BITS} AND bit_count(fp ^ fp2) <= {MAX_BITS}"


def leader_links(marks: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at most three bits apart, b the leader of a cell that a looks into.

    The leader of a cell is the smallest of its points, so pairs are at most as many as the
    cells looked into, whatever share of the rows one cell has.
    """
    points = _points(marks)
    leaders = _stored(points).groupBy("cell").agg(F.min(F.struct("fp", "u")).alias("first")).select("cell", "first.*")
    probes = _probes(points).drop("own")
    met = _met(probes, leaders, (probes.cell == leaders.cell) & F.expr(f"fp <> fp2 AND {NEAR}"))
    return met.select(F.col("fp2").alias("a"), F.col("fp").alias("b"))


def links(marks: DataFrame, apart: str | None = None) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints ``fp`` of ``marks`` at most three bits apart.

    Each pair of different fingerprints comes at least once, or with ``apart``, the name of a
    column, each that differs in it.  Whatever share of the rows one cell has, Spark splits it,
    as both sides of the join are plain shuffles.
    """
    names = [apart] if apart else []
    points = _points(marks, *names)
    stored, probes = _stored(points, *names), _probes(points, *names)
    near = (probes.cell == stored.cell) & (~F.col("own") | (F.col("fp2") < F.col("fp"))) & F.expr(NEAR)
    if apart:
        near = near & (F.col(apart) != F.col(f"{apart}2"))
    return _met(probes, stored, near).select(F.col("fp").alias("a"), F.col("fp2").alias("b"), *names, *[f"{n}2" for n in names])


def _moved(rooted: DataFrame, roots: DataFrame) -> DataFrame:
    """(fp, root) after the roots of ``rooted`` were joined further."""
    roots = stage(roots, "roots")
    further = sent(roots.select(F.col("node").alias("root"), F.col("root").alias("last")), roots.count())
    return rooted.join(further, "root", "left").select("fp", F.coalesce("last", "root").alias("root"))


def components(marks: DataFrame) -> DataFrame:
    """(fp, root) of distinct fingerprints ``fp``; links within three bits are followed to the smallest.

    A dense group has links in the square of its size, of which a forest is enough.  So first
    only leaders of cells are linked, and what that joins is one component.  Then all pairs
    are linked that are still in different components.  No link between components is lost,
    and those within one are not written.
    """
    rooted = marks.select("fp", F.col("fp").alias("root"))
    rooted = stage(_moved(rooted, connected_components(leader_links(marks))), "rooted")
    left = links(rooted, "root").select(F.col("root").alias("a"), F.col("root2").alias("b"))
    return stage(_moved(rooted, connected_components(left)), "rooted")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its ``key``, ``fp`` and ``component_id``.

    ``component_id`` is the smallest key among all rows whose fingerprints are reached
    in steps of at most three bits, the row itself included.  Copies share one
    fingerprint and are never paired.  Null keys are not the smallest unless they are
    alone, which gives null.  Repeated rows come back as often as they are; an empty
    table gives no rows; other columns are ignored.
    """
    marked = stage(
        fingerprints(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))), "fingerprints"
    )
    distinct = stage(marked.groupBy("fp").agg(F.min("key").alias("least")), "distinct-fingerprints")
    rooted = components(distinct)
    # Groups of one, which most are, keep their own smallest key and need no join.
    grouped = rooted.where("fp <> root").select("root").distinct().withColumn("grouped", F.lit(True))
    members = stage(rooted.join(grouped, "root").select("fp", "root"), "grouped")
    ids = members.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    ids = members.join(ids, "root").select("fp", "component_id")
    found = stage(distinct.join(ids, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "component-of")
    return marked.join(found, "fp").select(F.col("key").alias(key), "fp", "component_id")


def identity(key: str, text: str) -> Column:
    """A digest of key and text together."""
    return F.sha2(F.concat(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("-")), F.lit("|"),
                           F.coalesce(F.col(f"`{text}`"), F.lit(""))), 256)


def only(docs: DataFrame, kept: DataFrame, row: Column) -> DataFrame:
    """One row of ``docs`` for each ``__row`` of ``kept``, where ``row`` is its value."""
    rows = docs.withColumn("__row", row)
    single = rows.groupBy("__row").agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return single.join(stage(kept, "kept-rows"), "__row", "left_semi").drop("__row")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest key.

    Rows are told apart by key and text together: of rows equal in both one stays, null
    keys come last.  The texts are shuffled once, by that identity, after copies of a
    row within a task were dropped.
    """
    row = identity(key, text)
    marked = stage(
        fingerprints(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), row.alias("row"))),
        "fingerprints",
    )
    order = F.struct(F.col("key").isNull().alias("last"), F.col("key"), F.col("row"))
    distinct = stage(marked.groupBy("fp").agg(F.min(order).alias("first")), "distinct-fingerprints")
    kept = components(distinct).join(distinct, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return only(docs, kept.select(F.col("first.row").alias("__row")), row)
