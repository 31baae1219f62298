"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.binding import bind
from corpuscle.llm.common import without
from corpuscle.session import stage

SEED = "mix-1"
TEMPERATURE = 0.5
PART = 16.0  # largest mean that one uniform number is inverted for
TERMS = 120  # of a distribution with mean PART; what lies beyond is below 2^-52
BROADCAST_SOURCES = 100_000
BLOCK = 4096  # equal rows that are written out by one task at a time


def _uniform(*parts: Column) -> Column:
    """In [0, 1), from 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(SEED), *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def distribution(mean: Column) -> Column:
    """Struct of the number of equal parts a mean is cut into, and the distribution function of one part.

    The function is an array from k = 0, as far as it lies below every number
    ``_uniform`` can exceed; it is worked out once per mean.
    """
    parts = F.greatest(F.ceil(mean / PART), F.lit(1)).cast("int")

    def steps(part: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(TERMS)),
            F.struct(F.exp(-part).alias("p"), F.exp(-part).alias("below"), F.array().cast("array<double>").alias("all")),
            lambda s, k: F.struct(
                (s.p * part / k).alias("p"), (s.below + s.p * part / k).alias("below"),
                F.when(s.below <= 1 - 2.0**-52, F.array_append(s["all"], s.below)).otherwise(s["all"]).alias("all"),
            ),
            lambda s: s["all"],
        )

    return F.struct(parts.alias("parts"), bind(mean / parts, steps).alias("below"))


def poisson_count(drawn: Column, key: Column) -> Column:
    """A Poisson number fixed by ``key``: per part the smallest k whose distribution function exceeds a uniform number."""
    return F.aggregate(
        F.sequence(F.lit(1), drawn.parts), F.lit(0),
        lambda total, i: total + bind(_uniform(key, i), lambda u: F.size(F.filter(drawn.below, lambda b: b <= u))),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__d``, a digest of all columns, and ``__i``, a number from 0 among equal rows.

    Digests are counted before anything else moves.  Of rows that occur once nothing is
    shuffled; of equal rows one is kept per digest and written out again by its count, in
    blocks that any task may take.
    """
    parts = [F.coalesce(F.md5(F.col(f"`{c}`").cast("string").cast("binary")), F.lit("null")) for c in rows.columns]
    marked = rows.withColumn("__d", F.md5(F.concat_ws("|", *parts).cast("binary")))
    repeated = stage(marked.groupBy("__d").agg(F.count("*").alias("__c")).where("__c > 1"), "repeated-rows")
    if repeated.isEmpty():
        return marked.withColumn("__i", F.lit(0).cast("long"))
    once = marked.join(repeated, "__d", "left_anti").withColumn("__i", F.lit(0).cast("long"))
    names = [F.col(f"`{c}`") for c in rows.columns]
    one = marked.join(repeated, "__d").groupBy("__d").agg(F.first("__c").alias("__c"), F.first(F.struct(*names)).alias("__row"))
    blocks = one.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__c") - 1) / BLOCK)))).repartition("__d", "__b")
    start = F.col("__b") * BLOCK
    number = F.explode(F.sequence(start, F.least(start + BLOCK, F.col("__c")) - 1))
    return once.unionByName(blocks.select("__row.*", "__d", number.alias("__i")))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, epochs: float = 1.0,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with every row repeated a Poisson number of times and shuffled, with ``replica`` and ``order_key``.

    The mean of a row is that of its source: weight times ``epochs`` times all characters,
    over the characters of the source, so that a source makes up its weight of the text.
    ``weights`` names the shares, a source without one gets none; without ``weights`` a
    source's share is in proportion to its characters to the power ``temperature``.  A
    row's number depends on the seed, a digest of all its columns and, among equal rows, its
    number there, so that rows of one key, or without one, are drawn one by one, and any
    retried task draws the same.  Replicas count from 0.

    Null is a source of its own, null texts are empty, the key plays no part; a source
    without a character has a mean of weight times epochs.  An empty table gives no rows.
    Input columns named ``replica`` or ``order_key`` are replaced.  Sizes are combined before
    they are shuffled; the means are broadcast if there are at most ``BROADCAST_SOURCES``
    sources, else joined.  The rows are shuffled once, to a task by the hash of their
    random ``order_key`` and in its order within the task, so that any part of the output
    is a random sample and sorting by the key gives one order for all.
    """
    rows = without(docs, "replica", "order_key", "__d", "__i")
    name, chars = F.col(f"`{source}`"), F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    sizes = rows.groupBy(name.alias("__s")).agg(F.sum(chars.cast("long")).alias("__n"))
    totals = sizes.agg(F.count("*"), F.sum("__n"), F.sum(F.pow(F.col("__n").cast("double"), F.lit(float(temperature))))).first()
    count, total, scaled = totals[0], float(totals[1] or 0), float(totals[2] or 0)
    if weights is None:
        share = F.pow(F.col("__n").cast("double"), F.lit(float(temperature))) / F.lit(scaled or 1.0)
    else:
        share = F.lit(0.0)
        for label, weight in weights.items():
            share = F.when(F.col("__s").eqNullSafe(F.lit(label)), float(weight)).otherwise(share)
    mean = F.when(F.col("__n") > 0, share * F.lit(epochs * total) / F.col("__n")).otherwise(share * epochs)
    means = sizes.select(F.col("__s"), bind(mean, distribution).alias("__mean"))
    if count <= BROADCAST_SOURCES:
        means = F.broadcast(means)
    drawn = _numbered(rows).join(means, name.eqNullSafe(F.col("__s"))).withColumn(
        "__k", poisson_count(F.col("__mean"), F.concat_ws("|", "__d", "__i"))
    ).where("__k > 0")
    copies = drawn.select(
        *[F.col(f"`{c}`") for c in rows.columns], "__d", "__i", F.explode(F.sequence(F.lit(0), F.col("__k") - 1)).alias("replica"),
    )
    order = F.md5(F.concat_ws("|", F.lit(SEED), F.lit("order"), "__d", "__i", "replica").cast("binary"))
    return copies.withColumn("order_key", order).drop("__d", "__i").repartition("order_key").sortWithinPartitions("order_key")
