"""Small helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, as the one element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
