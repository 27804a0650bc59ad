"""Tests of association of two category columns, many at once, from their counts.

``statistics`` gives Pearson's statistic of every cross table (no continuity
correction) from one aggregate over cells and their margins.  ``tested`` adds
p-values: of the chi-square distribution where every expected count is 5 or more;
below that of the exact test for tables of two by two, else of random tables with
the same margins, drawn in chunks by the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import chi_square_tail, fisher_exact

#: The chi-square distribution serves from this expected count on.
LEAST_EXPECTED = 5
#: Random tables of a sparse test, and those that a task draws at a time.
DRAWS, CHUNK = 9_999, 500
#: Sparse tables of more cells than this are not tested.
MOST_CELLS = 100_000


def cells(tallied: DataFrame) -> DataFrame:
    """test, a, b, n of sets of two columns; rows without one of the values are not counted."""
    pair = tallied.select(F.col("frame").alias("test"), F.col("keys")[0].alias("a"), F.col("keys")[1].alias("b"), "n")
    return pair.where("a is not null and b is not null")


def statistics(cells: DataFrame) -> DataFrame:
    """test, n, levels_a, levels_b, degrees, statistic, least_expected: one row for each test that has rows."""
    rows, columns = cells.groupBy("test", "a").agg(F.sum("n").alias("r")), cells.groupBy("test", "b").agg(F.sum("n").alias("c"))
    # sum (n - e)^2 / e = t * (sum n^2 / (r c) - 1): cells without rows add nothing
    ratio = cells.join(rows, ["test", "a"]).join(columns, ["test", "b"]).groupBy("test").agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n") / (F.col("r").cast("double") * F.col("c"))).alias("s"))
    a = rows.groupBy("test").agg(F.count("*").alias("levels_a"), F.min("r").alias("least_r"))
    b = columns.groupBy("test").agg(F.count("*").alias("levels_b"), F.min("c").alias("least_c"))
    joined = ratio.join(a, "test").join(b, "test")
    statistic = F.greatest(F.lit(0.0), F.col("n") * (F.col("s") - 1))
    return joined.select("test", "n", "levels_a", "levels_b", ((F.col("levels_a") - 1) * (F.col("levels_b") - 1)).alias("degrees"), statistic.alias("statistic"), (F.col("least_r").cast("double") * F.col("least_c") / F.col("n")).alias("least_expected"))


def _tail():
    @F.pandas_udf("double")
    def run(statistic: pd.Series, degrees: pd.Series) -> pd.Series:
        return pd.Series([chi_square_tail(x, int(k)) if k > 0 else None for x, k in zip(statistic, degrees)], dtype="float64")

    return run


def tested(cells: DataFrame, draws: int = DRAWS, seed: int = 1) -> DataFrame:
    """The statistics with p_value and method (chi-square, exact, random tables); both null for a table of one row or column, or too large a sparse one."""
    stats = statistics(cells)
    sparse = (F.col("degrees") > 0) & (F.col("least_expected") < LEAST_EXPECTED)
    small = stats.where(sparse & (F.col("levels_a") * F.col("levels_b") <= MOST_CELLS))
    tables = cells.join(small, "test", "left_semi").groupBy("test").agg(F.collect_list(F.struct("a", "b", "n")).alias("cells"))  # up to MOST_CELLS cells
    parts = max(1, -(-draws // CHUNK))
    dealt = tables.join(small.select("test", "statistic"), "test").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition("test", "part")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(r.test, *_more_extreme(r.cells, r.statistic, min(CHUNK, draws - r.part * CHUNK), (seed, r.part))) for r in batch.itertuples()], columns=["test", "method", "p", "hits"])

    found = dealt.mapInPandas(draw, "test string, method string, p double, hits bigint").groupBy("test").agg(F.first("method").alias("way"), F.first("p").alias("exact"), F.sum("hits").alias("hits"))
    joined = stats.join(found, "test", "left")
    p = F.when(~sparse, _tail()("statistic", "degrees")).when(F.col("way") == "exact", F.col("exact")).otherwise((F.col("hits") + 1) / F.lit(draws + 1.0))
    method = F.when(F.col("degrees") <= 0, F.lit(None)).when(~sparse, "chi-square").otherwise(F.col("way"))
    return joined.select(*stats.columns, F.when(F.col("degrees") > 0, p).alias("p_value"), method.alias("method"))


def _more_extreme(cells: list, statistic: float, draws: int, seed: tuple[int, int]) -> tuple[str, float | None, int]:
    """Method, exact p-value, and how many random tables with these margins have the statistic or more."""
    rows = {x: i for i, x in enumerate(sorted({c["a"] for c in cells}))}
    columns = {x: i for i, x in enumerate(sorted({c["b"] for c in cells}))}
    table = np.zeros((len(rows), len(columns)), np.int64)
    for c in cells:
        table[rows[c["a"]], columns[c["b"]]] = c["n"]
    r, c = table.sum(1), table.sum(0)
    if table.shape == (2, 2):
        return "exact", fisher_exact(*table.ravel().tolist()), 0
    rng, expected, hits = np.random.default_rng(seed), np.outer(r, c) / r.sum(), 0
    for _ in range(draws):
        left, drawn = c.copy(), []
        for n in r[:-1]:
            drawn.append(rng.multivariate_hypergeometric(left, n, method="marginals"))
            left = left - drawn[-1]
        x = ((np.array([*drawn, left]) - expected) ** 2 / expected).sum()
        hits += x >= statistic * (1 - 1e-9)
    return "random tables", None, int(hits)
