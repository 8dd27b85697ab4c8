"""Binding of a value to a name inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often the body uses it.

    The optimiser may repeat an expression that a filter or a later column
    refers to; a lambda's variable is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
