import duckdb
import pytest

from spliceloom.llm import common, line_spread, queries


def brute(rows, min_sites):
    sites, home = {}, {}
    for i, t, s in rows:
        for x in (t or "").split("\n") if t is not None else []:
            if x := x.strip(" "):
                sites.setdefault(x, set()).add(s)
                home[x] = min([h for h in (home.get(x), i) if h is not None], default=None)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for i, t, _ in rows:
        if t is None:
            out.append((i, None))
            continue
        out.append((i, "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad or home[x.strip(" ")] == i)))
    return sorted(out, key=str)


def test_whole_table_against_sql(spark):
    d = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in queries.op3_line_spread(spark, d).collect())
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    assert got == sorted(con.sql(queries.ORACLE_SQL["op3_line_spread"]).fetchall())
    assert sum(r[2] for r in got) > 10


@pytest.mark.parametrize("few", [200_000, 0])
def test_edge_cases(spark, make_docs, few, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", few)
    bp = "accept all cookies"
    texts = [None, "", bp, f"{bp}\nown one", f" {bp} \n\n{bp}\nown two", bp, f"x\n{bp}", "\n\n", "own", f"last\n{bp}", ("long line " * 2000 + "\n") * 30 + bp, (None, bp + "\nnameless"), (4, f" {bp} \n\n{bp}\nown two")]
    docs = make_docs(texts, extra=True)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for n in (2, 4, 5, 6):
        clean = line_spread.remove_boilerplate(docs, n)
        assert clean.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == brute(rows, n)


def test_many_sites_take_the_sketch_path(spark):
    rows = [(i, f"shared\nhalf{i % 2}\nnear{i % 7}\nmine{i}", f"s{i % 100}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (2, 10, 30, 50, 51, 99, 100, 101):
        assert sorted(((r.doc_id, r.text) for r in line_spread.remove_boilerplate(docs, n).collect()), key=str) == brute(rows, n)


def test_empty(make_docs):
    assert line_spread.remove_boilerplate(make_docs(["x"]).limit(0)).collect() == []


def test_awkward_names(spark):
    docs = spark.createDataFrame([(i, "shared\nown %d" % i, f"s{i}", "x") for i in range(6)], "`doc.id` long, `the text` string, `si``te` string, text string")
    got = line_spread.remove_boilerplate(docs, 5, "doc.id", "the text", "si`te")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(i, "shared\nown 0" if i == 0 else f"own {i}", f"s{i}", "x") for i in range(6)]


def test_rows_of_one_id_with_other_texts(spark):
    rows = [(0, "b\nx", "s0"), (1, "b\ny", "s1"), (1, "z\nb\nb", "s2"), (2, "b", "s3"), (3, "b", "s4"), (1, "b\ny", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.row.doc_id, r.row.text, r.n_lines, r.n_removed) for r in line_spread.spread(docs, 5).collect())
    assert got == [(0, "b\nx", 2, 0), (1, "y", 2, 1), (1, "y", 2, 1), (1, "z", 3, 2), (2, "", 1, 1), (3, "", 1, 1)]


def test_long_text_takes_linear_time(spark):
    import time

    lines = [f"line {i}" for i in range(60_000)]
    docs = spark.createDataFrame([(i, "\n".join(lines), f"s{i}") for i in range(5)], "doc_id long, text string, source string")
    began = time.time()
    got = {r.row.doc_id: (len(r.row.text), r.n_lines, r.n_removed) for r in line_spread.spread(docs, 5).collect()}
    assert got == {0: (len("\n".join(lines)), 60_000, 0)} | {i: (0, 60_000, 60_000) for i in range(1, 5)}
    assert time.time() - began < 60
