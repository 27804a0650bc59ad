"""Chains by column expressions against the reader in Python."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.config import Assay, build_config
from spliceloom.functions import fuzzy
from spliceloom.operators import chain, chain_native
from spliceloom.plans import driver

SF = "/root/testdata/sf0.001"


def bases(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def edited(rng, s, edits):
    s = list(s)
    for _ in range(edits):
        at = rng.randrange(len(s))
        s[at] = rng.choice(["", bases(rng, 1), s[at] + bases(rng, 1)])
    return "".join(s)


def test_one_edit_equals_the_search(spark):
    rng = random.Random(3)
    pattern = "GGACAGCAGAGATCCA"
    texts = [bases(rng, rng.randrange(120)) + edited(rng, pattern, rng.randrange(4)) + bases(rng, rng.randrange(40)) for _ in range(400)] + ["", "GG", pattern, pattern[1:], pattern * 2, "A" * 60]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.p for r in df.select("i", chain_native.one_edit(F.col("s"), pattern).alias("p")).collect()}
    hits = [fuzzy.find(t.encode(), pattern.encode(), 1) for t in texts]
    assert got == {i: h and h[0] + 1 for i, h in enumerate(hits)} and 100 < sum(h is not None for h in hits) < 400


def test_overlap_equals_the_search(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        o = rng.choice([0, 5, 9, 10, 20, 49, 50, 99, 100, 150, 260])
        a, b = bases(rng, rng.choice([0, 7, 9, 30, 300])), bases(rng, rng.choice([0, 12, 280]))
        shared = bases(rng, o)
        other = list(shared)
        for _ in range(rng.randrange(1 + o // 40)):
            other[rng.randrange(o)] = rng.choice("ACGTN")
        rows.append((i, a + shared, "".join(other) + b))
    rows += [(1000, "A" * 200, "A" * 150), (1001, "AC" * 100, "AC" * 100), (1002, "ACGTACGTAC", "ACGTACGTAC")]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r.i: r.o for r in df.select("i", chain_native.overlap(F.col("a"), F.col("b")).alias("o")).collect()}
    want = dict(zip([r[0] for r in rows], fuzzy.overlaps([r[1].encode() for r in rows], [r[2].encode() for r in rows])))
    assert got == want and sum(o is not None for o in want.values()) > 100


@pytest.mark.parametrize("assay", list(Assay))
def test_events_equal_the_reader(spark, assay):
    """Known chains, reads with edits all over, random and short ones; every column, no Python worker in the plan."""
    rng = random.Random(5)
    exact = driver._view(spark, SF, "orders", driver.EXACT_SPARK).collect()
    rows = [(i, r.id, r.r1 if k else edited(rng, r.r1, 6), r.r2) for k in (0, 1) for i, r in enumerate(exact)]
    rows += [(i, "random", bases(rng, rng.randrange(4, 300)), bases(rng, rng.randrange(14, 300))) for i in range(100)]
    df = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], "read_ix long, id string, r1 string, r2 string")
    config = build_config(assay=assay, distance=0, genome=driver.GENOME)
    native = chain.events(df, config, hop=chain_native.splice_chain(config))
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    key = lambda r: r.read_ix
    assert sorted(native.collect(), key=key) == sorted(chain.events(df, config).collect(), key=key)


def test_only_exact_searches():
    with pytest.raises(ValueError):
        chain_native.splice_chain(build_config(distance=1))
