"""Pairs of equally long sequences within d substitutions, by keys with blanked groups of bases.

A sequence is cut into m groups of near-equal size and filed under itself with
every choice of d groups blanked.  Two sequences at most d substitutions apart
differ in at most d groups, so they meet under a key that blanks those.  A key of
L bases with d blanked groups of s bases belongs to at most 4**(d * s) sequences of
ACGT, whatever the number of sequences, and to n / 4**(L - d * s) of n random ones.

With m = d + 1 keys are few and unselective, with m = L (each base a group) they
are many and belong to 4**d sequences at most.  ``groups`` takes the smallest m at
which random sequences share a key with few others, so keys, pairs and the work
on them grow with n and not with its square.

Sequences that differ in fewer than d groups meet under several keys.  Their pair
is taken under one of them: the key whose further blanked groups come first.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Random sequences that share a key, on average, and keys of a sequence at most.
SHARED, MOST_KEYS = 4, 512
#: Lengths of which each has its number of groups; longer sequences have that of the longest.
LENGTHS = 64


def groups(length: int, distance: int, n: int) -> int:
    """Groups of a sequence of ``length`` bases among ``n``."""
    m = distance + 1
    while m < min(length, 62) and n > SHARED * 4 ** (length - distance * -(-length // m)) and comb(m + 1, distance) <= MOST_KEYS:
        m += 1
    return m


def _bound(i: Column, m: Column, length: Column) -> Column:
    """Where group i of m begins, from 0."""
    return F.floor(i * length / m).cast("int")


def _bit(i: Column) -> Column:
    return F.pow(F.lit(2.0), i).cast("bigint")


def _groups(length: Column, distance: int, n: int) -> Column:
    return F.get(F.array(*[F.lit(groups(k, distance, n)) for k in range(LENGTHS + 1)]), F.least(length, F.lit(LENGTHS)))


def _keys(s: Column, m: Column, distance: int) -> Column:
    """Array of structs: key, and the blanked groups as bits of a long."""
    length = F.length(s)

    def further(left: int):
        """Of a key those with one more group after its last blanked one blanked, as far as ``left`` more can follow."""

        def of(x: Column) -> Column:
            def blank(i: Column) -> Column:
                at, to = _bound(i, m, length), _bound(i + 1, m, length)
                return F.struct(F.overlay(x["key"], F.repeat(F.lit("_"), to - at), at + 1).alias("key"), (x["mask"] + _bit(i)).alias("mask"), (i + 1).alias("next"))

            return F.transform(F.sequence(x["next"], m - 1 - left), blank)

        return of

    keys = F.array(F.struct(s.alias("key"), F.lit(0).cast("bigint").alias("mask"), F.lit(0).alias("next")))
    for left in range(distance - 1, -1, -1):
        keys = F.flatten(F.transform(keys, further(left)))
    # too short to have more than d groups: all of one length are near
    every = F.array(F.struct(F.repeat(F.lit("_"), length).alias("key"), F.lit(-1).cast("bigint").alias("mask"), F.lit(0).alias("next")))
    return F.when(length > distance, keys).otherwise(every)


def pairs(df: DataFrame, distance: int, by: tuple[str, ...], column: str = "umi") -> DataFrame:
    """(by, a, b), a < b: every pair of different sequences of a group of rows and a length, at most ``distance`` substitutions apart, once."""
    u = df.select(*by, F.col(column).alias("s")).distinct()
    if distance < 1:
        return u.select(*by, F.col("s").alias("a"), F.col("s").alias("b")).where(F.lit(False))
    n = u.count()
    m = _groups(F.length("s"), distance, n)
    filed = u.withColumn("m", m).withColumn("k", F.explode(_keys(F.col("s"), F.col("m"), distance))).select(*by, "s", "m", "k.key", "k.mask")
    a, b = filed.withColumnRenamed("s", "a"), filed.withColumnRenamed("s", "b")
    met = a.join(b.drop("m"), [*by, "key", "mask"]).where("a < b")
    length = F.length("a")
    part = lambda s, g: F.substr(F.col(s), _bound(g, F.col("m"), length) + 1, _bound(g + 1, F.col("m"), length) - _bound(g, F.col("m"), length))
    differ = F.aggregate(F.sequence(F.lit(0), F.col("m") - 1), F.lit(0).cast("bigint"), lambda acc, g: acc + F.when(part("a", g) != part("b", g), _bit(g)).otherwise(0))
    told = met.withColumn("differ", F.when(length > distance, differ).otherwise(-1))
    mask = F.col("mask")
    begun = mask.bitwiseAND(F.bitwise_not(mask + 1))  # the blanked groups before the first one that is not
    once = mask.bitwiseAND(F.bitwise_not(F.col("differ"))).bitwiseAND(F.bitwise_not(begun)) == 0
    near = (length <= distance) | (F.col("m") == length) | (differing(F.col("a"), F.col("b")) <= distance)
    return told.where(once & near).select(*by, "a", "b")


def differing(a: Column, b: Column) -> Column:
    """Positions at which two strings of equal length differ."""
    return F.size(F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, 1) != F.substring(b, i, 1)))
