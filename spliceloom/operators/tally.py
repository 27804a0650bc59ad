"""Counts of many combinations of columns from one pass over the rows, and the frames of reports made of them.

A row gives one small struct to each set of columns that counts it; structs are
counted together, so the rows are read once and what moves is one row for each
combination and task.  Frames, shares, pivots and tests of association are made of
the one small table that results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut


@dataclass(frozen=True)
class Counted:
    """A set of columns to count: name to column (by its name, or an expression), and which rows count."""

    columns: dict[str, str | Column]
    where: Column | None = None


def tally(df: DataFrame, sets: dict[str, Counted]) -> DataFrame:
    """frame, keys (values as strings, in the order of the set's columns), n: stored once."""

    def item(name: str, s: Counted) -> Column:
        keys = F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in s.columns.values()])
        one = F.struct(F.lit(name).alias("frame"), keys.alias("keys"))
        return one if s.where is None else F.when(s.where, one)

    items = F.filter(F.array(*[item(n, s) for n, s in sets.items()]), lambda x: x.isNotNull())
    return cut(df.select(F.explode(items).alias("t")).groupBy("t.frame", "t.keys").agg(F.count("*").alias("n")))


def frame(tallied: DataFrame, sets: dict[str, Counted], name: str) -> DataFrame:
    """The counts of one set under its columns' names."""
    keys = [F.col("keys")[i].alias(c) for i, c in enumerate(sets[name].columns)]
    return tallied.where(F.col("frame") == name).select(*keys, "n")
