"""UMI pairs by blanked keys against all pairs; ranks without a sort of a whole category."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.operators import neighbours, umi


def all_pairs(rows, d):
    return {(c, a, b) for c, a in rows for e, b in rows if c == e and a < b and len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= d}


def mutated(rng, pool, length):
    """Random sequences and copies of some with one to three bases changed."""
    out = set(pool)
    for u in pool[: len(pool) // 2]:
        u = list(u)
        for _ in range(rng.randrange(1, 4)):
            u[rng.randrange(length)] = rng.choice("ACGTN_")
        out.add("".join(u))
    return list(out)


@pytest.mark.parametrize("d", [0, 1, 2, 3])
@pytest.mark.parametrize("n", [1, 10**6, 10**12])
def test_equals_all_pairs(spark, d, n, monkeypatch):
    """Few groups, some, and every base a group."""
    monkeypatch.setattr(neighbours, "groups", lambda length, distance, _, real=neighbours.groups: real(length, distance, n))
    rng = random.Random(d)
    rows = [(c, u) for c in "xy" for length in (1, 2, 3, 7, 14, 45, 70) for u in mutated(rng, ["".join(rng.choices("ACGT", k=length)) for _ in range(14)], length)]
    df = spark.createDataFrame([(c, u, 1) for c, u in rows] * 2, "final_category string, umi string, n long")
    got = [tuple(r) for r in umi.hamming_pairs(df, d).collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs(rows, d)


def test_groups_grow_with_the_sequences():
    assert [neighbours.groups(14, 1, n) for n in (1000, 10**5, 2 * 10**6, 10**9)] == [2, 3, 4, 14]
    assert neighbours.groups(14, 2, 10**9) == 14 and neighbours.groups(14, 2, 2 * 10**6) == 7
    assert neighbours.groups(45, 3, 10**9) == 5 and neighbours.groups(3, 5, 10) == 6
    for length in range(1, 65):
        for d in range(1, 6):
            assert d + 1 <= neighbours.groups(length, d, 10**15) <= max(d + 1, min(length, 62))


def test_candidates_grow_with_the_sequences(spark):
    """Rows of the join per sequence stay as they are when one category doubles."""
    found = []
    for n in (20_000, 40_000):
        u = spark.range(n).select(F.lit("c").alias("final_category"), F.substring(F.translate(F.md5(F.col("id").cast("string")), "0123456789abcdef", "ACGT" * 4), 1, 14).alias("umi")).distinct()
        m = neighbours.groups(14, 1, n)
        keys = u.select(F.explode(neighbours._keys(F.col("umi"), F.lit(m), 1)).alias("k")).groupBy("k.key", "k.mask").count()
        found.append(keys.agg(F.sum(F.col("count") * F.col("count"))).first()[0] / n / m)
    assert max(found) <= 2 * neighbours.SHARED


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_rank_of_one_category_is_spread(spark, partitions):
    rng = random.Random(1)
    rows = [("all", f"u{i}", rng.randrange(40)) for i in range(2000)] + [("b", "x", 1), ("b", "a", 1), ("b", "c", 9), (None, "n", 2), (None, "m", 2)]
    df = spark.createDataFrame(rows, "final_category string, umi string, n long")
    got = umi.parent_rank(df, partitions)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    want, at = set(), {}
    for c, u, n in sorted(rows, key=lambda r: (r[0] or "", -r[2], r[1])):
        at[c] = at.get(c, 0) + 1
        want.add((c, u, n, at[c]))
    assert {tuple(r) for r in got.collect()} == want
    assert umi.parent_rank(df.limit(0)).count() == 0
