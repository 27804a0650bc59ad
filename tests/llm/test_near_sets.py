import random

from test_simhash import brute_fp

import corpus_pipeline
from spliceloom.llm import common, near_sets, simhash

SF = "/root/testdata/sf0.01"


def brute_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute_kept(texts, similarity=0.8):
    """Smallest ids of the components of texts (id -> text) whose five-word sets have the similarity or whose fingerprints are within two bits."""
    sets, fps = {i: brute_set(t) for i, t in texts.items()}, {i: brute_fp(t, 5) for i, t in texts.items()}
    left, kept = sorted(sets), set()
    while left:
        kept.add(left[0])
        todo = [left.pop(0)]
        while todo:
            i = todo.pop()
            s = sets[i]
            near = [j for j in left if bin(fps[i] ^ fps[j]).count("1") <= 2 or min(len(s), len(sets[j])) >= similarity * max(len(s), len(sets[j])) and len(s & sets[j]) >= similarity * len(s | sets[j])]
            left = [j for j in left if j not in near]
            todo += near
    return kept


def test_stage_takes_out_edited_copies(spark, make_docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(200)]
    edited, other = base.copy(), base.copy()
    edited[50] = edited[120] = "changed"  # 10 of 196 shingles: similarity 0.90
    for i in range(5, 200, 20):
        other[i] = "changed"  # 0.59
    docs = make_docs([" ".join(x) for x in (base, edited, other)])
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF).collect()) == [0, 2]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.text for r in simhash.keep_one(docs).collect()}
    assert got == {i: texts[i] for i in brute_kept(texts)}


def test_large_group_of_near_copies(make_docs, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    base = [rng.choice(words) for _ in range(120)]
    texts = []
    for _ in range(150):
        x = base.copy()
        for i in rng.sample(range(120), 2):
            x[i] = rng.choice(words)
        texts.append(" ".join(x))
    texts += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    want = brute_kept(dict(enumerate(texts)))  # most pairs have a similarity of about 0.7, so that links are few
    for block in (near_sets.BLOCK, 4000):
        monkeypatch.setattr(near_sets, "BLOCK", block)
        assert {r.doc_id for r in simhash.keep_one(make_docs(texts)).collect()} == want
    assert 21 < len(want) < 170


def test_edge_cases(make_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = make_docs([None, "", "  \n", "one two", "ONE two", long, long, (None, long), (5, long)], extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 5]
    assert simhash.keep_one(docs.limit(0)).collect() == []
    docs = make_docs([(None, "a b c d e"), (None, "a b c d e"), (None, "quite some other words here"), (7, "one more text"), (8, "x y"), (8, "p q r"), (9, "x y")])
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == ["a b c d e", "one more text", "p q r", "quite some other words here", "x y"]


def test_large_buckets_are_read_in_parts(spark):
    """A bucket longer than a task holds gives the same sets, linked to its first one, and neighbours by size."""
    rows = [(k, 10 + i // 7, 1000 * k + i) for k, m in ((1, 5), (2, 400), (3, 16), (4, 17), (5, 90)) for i in range(m)]
    df = spark.createDataFrame(rows, "key long, n long, h long").coalesce(1)
    whole = {tuple(r) for r in near_sets.candidates(df, 0.8).collect()}
    for most in (40, 100):
        parts = {tuple(r) for r in near_sets.candidates(df, 0.8, most).collect()}
        assert {x for x in whole if x[2]} == {x for x in parts if x[2]}
        assert {x for x in whole if not x[2]} <= parts
        assert all(a // 1000 == b // 1000 for a, b, _ in parts)


def test_many_rows_are_joined_by_a_shuffle(make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    docs = make_docs(["a b c d e", "a b c d e", "x y z", (1, "a b c d e"), (7, "x y z"), (7, "x y z"), (None, "p q"), (None, "p q")], extra=True)
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str) == sorted([(0, "a b c d e"), (2, "x y z"), (None, "p q")], key=str)
