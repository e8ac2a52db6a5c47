"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row.

    A lambda evaluates what it refers to once per element, so an expression
    used inside one is bound to a name first.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
