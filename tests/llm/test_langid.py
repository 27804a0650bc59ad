import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spliceloom.llm import langid, queries
from spliceloom.llm.common import utf8


def brute_grams(text):
    """Character n-grams of the folded text, as strings."""
    low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
    out = []
    words = " ".join(low.split())
    words = (" " if low[:1] == " " else "") + words + (" " if low[-1:] == " " and words else "")
    for n in langid.ORDERS:
        out += [words[i : i + n] for i in range(len(words) - n + 1)]
    return out


def test_held_out_accuracy_and_columns(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op6_langid(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs if got[r.doc_id].held_out and r.lang]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def buckets(text, step=1 << 19):
    letters = np.zeros(1, np.int64)
    got = [b for b, _ in langid.grams(*utf8(pa.array([text], pa.string())), letters, step)]
    return sorted(np.concatenate(got).tolist()) if got else [], int(letters[0])


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1 << 19])
def test_gram_counts(step):
    texts = ["Abc dé!", "", "x", "..a--b..", None, " lead", "née ÀB  1 漢字 😀z"]
    letters = np.zeros(len(texts), np.int64)
    rows = [r for _, r in langid.grams(*utf8(pa.array(texts, pa.string())), letters, step)]
    assert letters.tolist() == [5, 0, 1, 2, 0, 4, 8]
    total = np.bincount(np.concatenate(rows), minlength=len(texts))
    assert total.tolist() == [len(brute_grams(t)) for t in texts]
    assert [buckets(t, step) for t in texts] == [buckets(t) for t in texts]


def brute_posteriors(learn, texts):
    """Multinomial naive Bayes in plain Python; learn: (text, language)."""
    counts, docs = {}, Counter()
    for t, lang in learn:
        if t is not None and lang is not None:
            docs[lang] += 1
            counts.setdefault(lang, Counter()).update(buckets(t)[0])
    langs = sorted(docs)
    every = {k: sum(counts[k].values()) + 0.5 * langid.BUCKETS for k in langs}
    prior = sum(docs.values()) + len(langs)
    out = []
    for t in texts:
        b, letters = buckets(t)
        if not letters or not langs:
            out.append(("und", 0.0))
            continue
        score = {k: math.log((docs[k] + 1) / prior) + sum(math.log((counts[k][x] + 0.5) / every[k]) for x in b) for k in langs}
        best = max(langs, key=lambda k: score[k])
        out.append((best, 1 / sum(math.exp(score[k] - score[best]) for k in langs)))
    return out


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows}
    want = brute_posteriors([(r.text, r.lang) for r in rows if not held[r.doc_id]], [r.text for r in rows])
    got = {r.doc_id: r for r in queries.op6_langid(spark, d).collect()}
    for r, (lang, p) in zip(rows, want):
        x = got[r.doc_id]
        assert (x.held_out, x.lang_pred) == (held[r.doc_id], lang) and x.score == pytest.approx(p, abs=1e-3), (x, lang, p)


def test_edge_cases(make_docs):
    docs = make_docs(["the cat and the dog", "der hund und die katze", None, "", "123 !!", (None, "the dog"), (1, "die katze"), "und " * 20_000], extra=True)
    model = langid.fit(docs)
    assert model[0] == ["de", "en"]
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(docs, model).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (0, "en"), (1, "de")} <= got
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == 5
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs.limit(0))).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).collect() == []


def test_too_many_languages(make_docs, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 1)
    with pytest.raises(ValueError):
        langid.fit(make_docs(["a b", "c d"]))
