"""Fill-in-middle against plain Python, exact round trips, and awkward tables."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from spliceloom.llm import fim, queries

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " ", "\n", "a", "abc def", "naïve café 12 €", "𝄞 clef\U0001f600x", "no <P> here", "<S>", "x<M>", "ends with <", "<", "<P", "S>", "M>P>S>", "<<<>>>", "P>a<S<", "<S<P<M",
    "tab\tand\r\nline\x00end", "A-Z" * 500, "one two three four five six seven eight " * 400,
]


def brute(i, text, seed=1, rate=90, spm_rate=20):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    x = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, len(u), "plain", None, None, None, text
    pre, mid, suf = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    if h[3] % 100 < spm_rate:
        return i, len(u), "spm", pre, mid, suf, f"<S>{suf}<P>{pre}<M>{mid}"
    return i, len(u), "psm", pre, mid, suf, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("seed, rate, spm_rate", [(1, 90, 20), (7, 100, 50), (3, 0, 0)])
def test_equals_brute_force_and_reads_back(spark, make_docs, seed, rate, spm_rate):
    rows = [(k * 31 + j, t) for k in range(6) for j, t in enumerate(TEXTS)] + [(None, "a null id"), (5, "twice"), (5, "twice")]
    docs = make_docs(rows, extra=True)
    got = fim.transform(docs, seed=seed, rate=rate, spm_rate=spm_rate).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[-1])
    want = [(*brute(i, t, seed, rate, spm_rate), t or "") for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert rate == 0 or {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark, make_docs):
    assert fim.transform(make_docs([])).count() == 0


def test_query_is_native_and_equals_sql(spark):
    got = queries.op12_fim(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert got.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(queries.ORACLE_SQL["op12_fim"]).fetchall())
