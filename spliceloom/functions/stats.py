"""Numbers of the UMI model: cut-off, random-neighbour risk, and R's rounding of halves."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: coefficients of the cut-off polynomial, from the sixth degree to the constant
CUTOFF = (-9.59e-27, 3.27e-21, -3.05e-16, 1.2e-11, -2.19e-7, 0.004044, 2.273)
# ---- end of fixed values
#: Beyond this maximum the polynomial falls to the floor (its peak lies before).
SANE_MAXIMUM = 187_750


def cutoff(m: Column) -> Column:
    """Reads above which a UMI makes a family when the most frequent one has ``m``; 2 at least."""
    x = m.cast("double")
    total = F.lit(CUTOFF[-1])
    for power, c in zip(range(len(CUTOFF) - 1, 0, -1), CUTOFF):
        total = total + F.lit(c) * F.pow(x, F.lit(float(power)))
    n = F.round(total)
    return F.when((m <= 10) | (n < 3), 2).otherwise(n).cast("bigint")


def neighbours(length: Column, distance: int) -> Column:
    """Sequences within ``distance`` substitutions of one of ``length`` bases, itself left out: the sum of C(length, k) 3^k."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * (length - k + 1).cast("double") * 3.0 / k.cast("double")
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(distance)), start, add)["total"]


def neighbour_risk(n: Column, length: Column, distance: int) -> Column:
    """Expected random neighbours of a UMI among ``n`` distinct ones of a length."""
    if distance == 0:
        return F.lit(0.0)
    more = (n - 1).cast("double")
    rate = neighbours(length, distance) / (F.pow(F.lit(4.0), length.cast("double")) - 1)
    return F.when(n <= 1, F.lit(0.0)).when(length <= distance, more).otherwise(more * rate)


def chi_square_tail(x: float, degrees: int) -> float:
    """P(chi-square > x): the upper incomplete gamma function, its terms scaled by their logarithm, so that nothing overflows."""
    a, z = degrees / 2, x / 2
    if z <= 0:
        return 1.0
    scale = a * math.log(z) - z - math.lgamma(a)
    if z < a + 1:  # one less the series of the lower function
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= z / n
            total += term
        return min(1.0, max(0.0, 1 - total * math.exp(scale)))
    # continued fraction of the upper one, by its convergents' ratios
    b = z + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 100_000):
        k = i * (a - i)
        b += 2
        d = 1 / (k * d + b or 1e-300)
        c = b + k / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return min(1.0, math.exp(scale + math.log(h)) if h > 0 and scale + math.log(h) > -745 else 0.0)


def fisher_exact(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact test of a table of two by two: the sum of the tables that are no more probable."""
    import numpy as np

    r, s, left = a + b, c + d, a + c
    lo, hi = max(0, left - s), min(r, left)
    x = np.arange(lo, hi + 1, dtype=float)
    # log of the ratio of neighbouring probabilities, summed up; the largest scaled to 1
    step = np.log((r - x[:-1]) * (left - x[:-1])) - np.log((x[:-1] + 1) * (s - left + x[:-1] + 1))
    log = np.concatenate([[0.0], np.cumsum(step)])
    p = np.exp(log - log.max())
    return float(min(1.0, p[p <= p[a - lo] * (1 + 1e-7)].sum() / p.sum()))
