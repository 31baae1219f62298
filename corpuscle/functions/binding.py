"""Work out a subexpression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once.

    An expression named inside a lambda is evaluated again for every element;
    the variable of an enclosing lambda is not.
    """
    return F.transform(F.array(value), use)[0]
