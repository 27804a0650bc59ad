"""Quality rules: base counts against plain Python, divergences against numpy, planted junk and clean texts, the query against SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spliceloom.llm import quality, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " ", "\n\n", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "a " * 40, "x y " * 9 + "z", "same line\nsame line\n \nsame line\n", "tab\tand\x0bvt\x0cff\rcr nbsp em",
    "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8", "𝄞 a # * $ % & | < > ##", "#" * 50, "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 30 + "end", " ".join(str(i % 97) for i in range(5000)),
]


def test_base_counts(spark, make_docs):
    docs = make_docs(TEXTS, extra=True)
    got = docs.select("doc_id", quality.base_counts(F.coalesce("text", F.lit(""))).alias("b")).select("doc_id", "b.*").collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_base(t) for i, t in enumerate(TEXTS)}


def divergence(p, q):
    p, q = np.asarray(p, float) / np.sum(p), np.asarray(q, float)
    half = lambda a, b: float(np.sum(np.where(a > 0, a * np.log2(np.where(a > 0, 2 * a / (a + b), 1)), 0)))
    return (half(p, q) + half(q, p)) / 2


def class_counts(text):
    words = "".join(WORD.findall(text))
    c = [len(re.findall(p, words)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[.,;:!?'\"()-]", "[#*$%&|<>]", r"[^\x00-\x7F]")]
    return [*c, len(words) - sum(c)]


def test_divergences(spark, make_docs):
    """References and divergences of the sf0.001 documents, by language, from scratch."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    refs = {r.lang: r for r in quality.references(docs, least=5000).collect()}
    words = {}
    for r in rows:
        for g in (r.lang, None):
            words.setdefault(g, Counter()).update(re.findall(r"[^\W\d_]+", r.text.lower()))
    assert set(refs) == {g for g, c in words.items() if g is None or sum(c.values()) >= 5000}
    for g, ref in refs.items():
        top = sorted(words[g].items(), key=lambda x: (-x[1], x[0]))[:50]
        total = sum(words[g].values())
        assert ref.words == [w for w, _ in top]
        assert np.allclose(ref.shares, [n / total for _, n in top] + [1 - sum(n for _, n in top) / total])
        shares = [[2000 * x // sum(c) for x in c] for c in (class_counts(r.text) for r in rows if g in (None, r.lang)) if sum(c) >= quality.MIN_CLASS_CHARS]
        middle = np.array([sorted(col)[(len(col) - 1) // 2] + 0.5 for col in zip(*shares)])
        assert np.allclose(ref.classes, middle / middle.sum())
    judged = {r.id: r for r in quality.judge(docs, quality.references(docs, least=5000)).select("row.doc_id", "*").withColumnRenamed("doc_id", "id").collect()}
    for r in rows:
        ref, got, found = refs.get(r.lang, refs[None]), judged[r.doc_id], re.findall(r"[^\W\d_]+", r.text.lower())
        if got.word_chars >= quality.MIN_CLASS_CHARS:
            assert got.class_divergence == pytest.approx(divergence(class_counts(r.text), ref.classes), abs=1e-9)
        else:
            assert got.class_divergence is None
        if len(found) >= quality.MIN_COMMON_WORDS:
            c = Counter(found)
            counts = [c[w] for w in ref.words]
            assert got.common_divergence == pytest.approx(divergence([*counts, len(found) - sum(counts)], ref.shares), abs=1e-9)
        else:
            assert got.common_divergence is None
        assert tuple(got[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_base(r.text)


def test_planted_texts(spark):
    """Clean texts stay, symbol junk, tables, other alphabets and word salad without common words go."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    refs = quality.references(docs)
    clean = [r.text for r in docs.where("lang = 'en'").collect() if len(r.text) > 3000 and not re.search(r"[#*$%&|<>@]", r.text) and brute_base(r.text)[4] == 0]
    assert len(clean) >= 5
    junk = {"symbols": [re.sub(" ", "### ", t) for t in clean], "table": [re.sub(" ", " | ", t) for t in clean], "greek": [t.translate({c: 0x3B1 + c % 24 for c in range(97, 123)}) for t in clean], "salad": [" ".join(w for w in t.split() if len(w) > 5) for t in clean]}
    table = lambda texts: spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert quality.judge(table(clean), refs).where("kept").count() == len(clean)
    for name, texts in junk.items():
        assert quality.judge(table(texts), refs).where("kept").count() == 0, name


def test_awkward_tables(spark, make_docs):
    docs = make_docs(TEXTS + ["the end of it " * 60] * 2, extra=True)
    refs = quality.references(docs)
    out = quality.keep_good(docs, refs)
    assert out.columns == docs.columns
    judged = quality.judge(docs, refs)
    assert judged.count() == len(TEXTS) + 2 and judged.where("not kept and not base_failed").count() + judged.where("kept").count() == judged.where("not base_failed").count()
    assert judged.where("n_words < 20 and kept").isEmpty()
    empty = make_docs([])
    assert quality.judge(empty, quality.references(empty)).count() == 0
    # references of no documents judge nothing
    assert quality.judge(docs, quality.references(empty)).where("class_divergence is not null or common_divergence is not null").isEmpty()


def test_query_is_native_and_equals_sql(spark):
    got = queries.op11_quality(spark, SF)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.dtypes[:8] == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", "boolean"), ("kept", "boolean")]
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op11_quality"])
    assert want.columns == got.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_texts_are_searched_once_for_each_purpose(spark, monkeypatch):
    """A filter on word characters counted them twice; symbols are one of the classes; a common word is looked for among those of its length."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    refs = quality.references(docs)
    judged = plan(quality.judge(docs, refs))
    assert judged.count("[#*$%&|<>]+") == 1
    monkeypatch.setattr(quality, "cut", lambda df: df)
    assert not [x for x in plan(quality.references(docs)).split("\n") if "Filter" in x and "regexp_replace" in x]
    words = F.array(*[F.lit(w) for w in ("the", "a", "to", "of", "einer", "i")])
    lists = spark.range(1).select(quality.by_length(words).alias("x")).first().x
    assert lists == [",,,,,", ",a,,,,i", ",,to,of,,", "the,,,,,", ",,,,,", ",,,,einer,"]
    found = spark.range(1).select(F.transform(words, lambda w: F.find_in_set(w, F.get(quality.by_length(words), F.length(w)))).alias("x")).first().x
    assert found == [1, 2, 3, 4, 5, 6]
