"""Every query with SQL against DuckDB; the others run and have rows."""

import math

import duckdb
import pytest

from spliceloom import registry

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module", params=["sf0.001"])
def data(request):
    d = f"/root/testdata/{request.param}"
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    return d, con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = lambda v: f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, data, name):
    d, con = data
    got = registry.QUERIES[name](spark, d)
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    assert mine == rows_of(want.columns, want.fetchall())
    assert mine


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, data, name):
    assert registry.QUERIES[name](spark, data[0]).count() > 0


def test_flagship_reads_most_mock_chains(spark, data):
    from pyspark.sql import functions as F

    rows = registry.flagship(spark, data[0]).where("not sequence_id like '%noD1%' and not sequence_id like '%D1_unknown%'")
    right = rows.where(F.col("sequence_id").contains(F.concat(F.lit("mock_"), "splice_category", F.lit("_")))).count()
    assert right / rows.count() > 0.97
