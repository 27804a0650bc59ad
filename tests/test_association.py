"""Tests of association against published values and full enumeration; report frames from one pass over the rows."""

import math
from itertools import product

import pytest
from pyspark.sql import functions as F

from spliceloom.functions.stats import chi_square_tail, fisher_exact
from spliceloom.operators import annotate, association, report
from spliceloom.plans import driver, pipeline

SF = "/root/testdata/sf0.001"


def test_tail_at_published_points():
    """Critical values of printed tables (5 %, 1 %, 0.1 %), small and large ones."""
    for degrees, x, p in [(1, 3.841, 0.05), (1, 10.828, 0.001), (2, 5.991, 0.05), (5, 15.086, 0.01), (10, 18.307, 0.05), (30, 43.773, 0.05), (100, 124.342, 0.05), (100, 149.449, 0.001), (1000, 1074.679, 0.05), (1000, 1143.917, 0.001), (10, 3.940, 0.95), (100, 77.929, 0.95)]:
        assert chi_square_tail(x, degrees) == pytest.approx(p, rel=2e-3), degrees
    assert chi_square_tail(5.0, 2) == pytest.approx(math.exp(-2.5), rel=1e-12) and chi_square_tail(0, 3) == 1
    assert chi_square_tail(2.3, 1) == pytest.approx(math.erfc(math.sqrt(1.15)), rel=1e-10)


@pytest.mark.parametrize("degrees", [1, 2, 95, 140, 342, 1000, 10**6])
def test_tail_never_overflows(degrees):
    values = [chi_square_tail(x, degrees) for x in (1e-9, 1, 10, 1e2, 1e3, 1e5, 1e7, 1e9)]
    assert all(0 <= p <= 1 for p in values) and values == sorted(values, reverse=True) and values[-1] == 0


def test_exact_test_at_published_values():
    assert fisher_exact(3, 1, 1, 3) == pytest.approx(0.4857, abs=1e-4)  # the lady tasting tea
    assert fisher_exact(2, 15, 10, 3) == pytest.approx(0.0005367, abs=1e-7)  # convictions of twins
    assert fisher_exact(0, 5, 5, 0) == pytest.approx(2 / math.comb(10, 5)) and fisher_exact(7, 0, 3, 0) == 1


def table(spark, name, rows):
    return [(name, [str(i), str(j)], n) for i, r in enumerate(rows) for j, n in enumerate(r) if n]


def all_tables(r, c):
    """Every table with these margins and its probability."""
    if len(r) == 1:
        return [([list(c)], math.prod(map(math.factorial, r)))]
    out = []
    for first in product(*[range(min(x, r[0]) + 1) for x in c]):
        if sum(first) == r[0]:
            out += [([list(first), *t], None) for t, _ in all_tables(r[1:], [x - y for x, y in zip(c, first)])]
    return out


def test_p_values(spark):
    party, tea, sparse = [[762, 327, 468], [484, 239, 477]], [[3, 1], [1, 3]], [[4, 0, 1], [0, 5, 1], [1, 1, 2]]
    rows = table(spark, "party", party) + table(spark, "tea", tea) + table(spark, "sparse", sparse) + [("one", ["a", "x"], 5), ("one", ["a", "y"], 7), ("one", [None, "y"], 9)]
    got = {r.test: r for r in association.tested(association.cells(spark.createDataFrame(rows, "frame string, keys array<string>, n long"))).collect()}
    assert (round(got["party"].statistic, 2), got["party"].degrees, got["party"].method) == (30.07, 2, "chi-square") and got["party"].p_value == pytest.approx(2.954e-07, rel=1e-3)
    assert got["tea"].p_value == pytest.approx(0.4857, abs=1e-4) and got["tea"].method == "exact"
    assert got["one"].degrees == 0 and got["one"].p_value is None and got["one"].n == 12
    r, c = [sum(x) for x in sparse], [sum(x) for x in zip(*sparse)]
    n = sum(r)
    stat = lambda t: sum((x - a * b / n) ** 2 / (a * b / n) for x, (a, b) in zip([x for row in t for x in row], product(r, c)))
    weight = lambda t: 1 / math.prod(math.factorial(x) for row in t for x in row)
    tables = [t for t, _ in all_tables(r, c)]
    exact = sum(weight(t) for t in tables if stat(t) >= stat(sparse) - 1e-9) / sum(map(weight, tables))
    assert got["sparse"].method == "random tables" and got["sparse"].p_value == pytest.approx(exact, abs=4 * math.sqrt(exact / association.DRAWS))


def as_rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_frames_of_one_pass(spark):
    """Every frame equals the one made of the rows themselves, which are read once for all of them."""
    rows = driver.samples(spark, SF).cache()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    counted = rows.mapInPandas(count, rows.schema)
    frames, tests = pipeline.report_frames(counted)
    spliced = report.spliced_only(rows)
    cross = lambda by, of=spliced: report.cross_table(of, *by)
    want = {
        "spliced_classes": report.percent(rows, ["spliced"]), "spliced_known": report.percent(report.known_only(rows), ["spliced"]), "size_classes": report.percent(spliced, ["size_class"]), "d1_types": report.percent(spliced, ["D1_type"]),
        "isoforms": report.percent(spliced, ["splice_cat2"]), "isoforms_by_d1": report.pivot(spliced, "splice_cat2", "D1_type_revised", list(annotate.D1_LEVELS)), "acceptors_by_d1": cross(["D1_type_revised", "main_acceptor_after_d1"]),
        "links": report.links(rows), "cascade": report.cascade(rows), "flow": report.flow(rows), "after_a1": report.percent(annotate.reaching_a1(rows), ["A1_fate"]), "after_a2": cross(["upstream_event", "A2_fate"], annotate.reaching_a2(rows)), "sankey": report.sankey(report.cascade(rows)),
    }
    for name, df in want.items():
        assert as_rows(frames[name]) == as_rows(df), name
    shown, by_sample = pipeline.comparison_frames(counted)
    assert as_rows(shown["d1_types"]) == as_rows(report.percent(spliced.withColumn("D1_type_revised2", annotate.d1_type_revised2(F.col("D1_type"))), ["id", "D1_type_revised2"], ["id"]))
    assert as_rows(shown["percent_spliced"]) == as_rows(report.percent_spliced(rows)) and as_rows(shown["rows"]) == as_rows(report.counts(rows, "id"))
    for df in [*frames.values(), *shown.values()]:
        df.collect()
    assert seen.value == 2 * rows.count()
    assert set(tests) == {"isoforms_by_d1", "isoforms_by_size", "acceptors_by_d1", "after_a2"} and all(p is None or 0 <= p[0] <= 1 for p in [*tests.values(), *by_sample.values()])
    assert "isoforms" in by_sample
    rows.unpersist()
