"""Vector arithmetic on array columns.

These are the per-row forms.  Scoring many vectors against many others goes
through ``operators.search``, which works on whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.binding import bind


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def norm(vec: Column) -> Column:
    return F.sqrt(_total(F.transform(as_double(vec), lambda x: x * x)))


def is_finite(vec: Column) -> Column:
    """Whether the squares of a vector sum to a finite number; false for null vectors and elements."""
    squares = _total(F.transform(as_double(vec), lambda x: x * x))
    return bind(squares, lambda s: F.coalesce(~F.isnan(s) & (s < float("inf")), F.lit(False)))


def l2_normalize(vec: Column) -> Column:
    """Unit vector; the zero vector stays as it is."""

    def scaled(length: Column) -> Column:
        return F.when(length == 0, as_double(vec)).otherwise(F.transform(as_double(vec), lambda x: x / length))

    return bind(norm(vec), scaled)


def _prefix(vec: Column, other: Column) -> Column:
    return F.slice(as_double(vec), F.lit(1), F.least(F.size(vec), F.size(other)))


def _zip_prefix(a: Column, b: Column, combine) -> Column:
    return F.zip_with(_prefix(a, b), _prefix(b, a), combine)


def dot(a: Column, b: Column) -> Column:
    """Dot product over the common prefix."""
    return _total(_zip_prefix(a, b, lambda x, y: x * y))


def add(a: Column, b: Column) -> Column:
    return _zip_prefix(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return _zip_prefix(a, b, lambda x, y: x - y)


def cosine(a: Column, b: Column) -> Column:
    """Cosine with the dot product over the common prefix; 0 when a norm is 0."""
    return bind(norm(a) * norm(b), lambda scale: F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale))


def cosine_strict(a: Column, b: Column) -> Column:
    """Cosine that is 0 for empty vectors and for vectors of unequal length."""
    comparable = (F.size(a) > 0) & (F.size(a) == F.size(b))
    return F.when(comparable, cosine(a, b)).otherwise(F.lit(0.0))


def squared_distance(a: Column, b: Column) -> Column:
    return _total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def euclidean_score(a: Column, b: Column) -> Column:
    """1 / (1 + squared distance): the larger, the closer."""
    return 1.0 / (1.0 + squared_distance(a, b))


def dimension(vec: Column) -> Column:
    return F.size(vec)


def fixed_point(value: Column, digits: int = 6) -> Column:
    """Round half up by plain double arithmetic, so every engine gets the same bits."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale
