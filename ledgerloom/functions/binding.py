"""Evaluate an expression once and use its value several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer inlines aliases, so a value used in several branches of a filter or a CASE would
    be computed in each of them, and a long chain would outgrow the size that the JVM compiles.
    A lambda variable is bound once and keeps the generated code small.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
