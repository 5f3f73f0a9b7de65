"""Name a sub-expression inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once.

    Where a rule uses its input many times, plain nesting would copy the input's whole
    expression tree at each use. For columns on the hot path a projection does the same
    job and stays inside code generation; this is for rare branches and for lambdas.
    """
    return F.transform(F.array(value), body)[0]
