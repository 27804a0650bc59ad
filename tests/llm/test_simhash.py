import random
from pathlib import Path

import numpy as np
import pytest
import xxhash

from spliceloom.llm import simhash

ROOT = Path(__file__).parents[2]


def brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] or [words]
    hs = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    """id -> smallest id reachable over links of two or fewer bits."""
    best = {}
    left = list(pairs)
    while left:
        todo, group = [left.pop()], []
        while todo:
            x = todo.pop()
            group.append(x)
            near = [y for y in left if bin(x[1] ^ y[1]).count("1") <= 2]
            left = [y for y in left if y not in near]
            todo += near
        ids = [i for i, _ in group if i is not None]
        best |= {i: min(ids) for i in ids}
    return best


def test_masks_cover_every_pair_within_the_radius():
    keys = simhash.masks()
    for i in range(64):
        for j in range(64):
            assert any((k & (1 << i | 1 << j)) == 0 for k in keys)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = simhash.near_duplicates(docs).collect()
    fps = {i: brute_fp(t) for i, t in texts.items()}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == brute_components(list(fps.items()))


@pytest.mark.parametrize("most", [simhash.MAX_BUCKET, 20])
def test_links_lose_nothing_when_buckets_are_divided(spark, most):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)] + [0]
    fps = set(base)
    for _ in range(300):
        x = rng.choice(sorted(fps)[:60] + base)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    rows = [(i, int(np.array(x, np.uint64).view(np.int64))) for i, x in enumerate(sorted(fps))]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.classes(df, most).collect()}
    want = brute_components([(i, x) for i, x in enumerate(sorted(fps))])
    assert {i: found[x] for i, x in rows} == want


def test_edge_cases(make_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = make_docs([None, "", "  \n", "one two", "ONE two", long, long, (None, long), (5, long)], extra=True)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (5, 5), (6, 5), (None, 5), (5, 5)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 3, 5]


def test_division_ends():
    """Whatever is left out, four bits or fewer are in the end."""
    level = {simhash.EVERY}
    for _ in range(6):
        level = {~m & simhash.EVERY for left in level for m in simhash.masks(left)}
        if max(bin(x).count("1") for x in level) <= 4:
            break
    assert max(bin(x).count("1") for x in level) <= 4


def test_a_hot_bucket_takes_bounded_memory():
    """A full bucket of the largest size, in a process of its own."""
    import subprocess
    import sys

    code = """
import numpy as np, resource
from spliceloom.llm import simhash
n = simhash.MAX_BUCKET
left = [i for i in range(64) if not simhash.masks()[0] >> i & 1]
x = np.random.default_rng(0).integers(0, 1 << 15, n, dtype=np.uint64)
x = np.unique(sum((x >> np.uint64(k) & np.uint64(1)) << np.uint64(left[k]) for k in range(15)) | np.arange(n, dtype=np.uint64) % np.uint64(2) << np.uint64(left[20]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
a, b = simhash.star_links(x, np.zeros(len(x), np.int64), np.full(len(x), simhash.masks()[0], np.uint64))
assert len(a) > len(x) / 2
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], stdout=subprocess.PIPE, text=True, check=True, cwd=ROOT).stdout)
    assert grown < 200, grown


def test_rows_without_an_id(make_docs):
    docs = make_docs([(None, "a b c d e"), (None, "a b c d e"), (None, "quite some other words here"), (7, "one more text")])
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == ["a b c d e", "one more text", "quite some other words here"]


def test_repeated_id_with_different_texts(make_docs):
    docs = make_docs([(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (1, "a b c d e f"), (0, "k l m n o"), (3, "k l m n o"), (3, "one more text")])
    want = [(0, "k l m n o"), (1, "a b c d e f"), (1, "u v w x y z"), (3, "one more text")]
    for _ in range(2):
        assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs.repartition(3)).collect()) == want


def test_awkward_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "other words", "z"), (None, "a b c d e f", "w"), (1, "a b c d e f", "v")], "`doc.id` long, `my text` string, __h string")
    got = simhash.keep_one(docs, key="doc.id", text="my text")
    assert got.columns == docs.columns
    rows = sorted(map(tuple, got.collect()))
    assert [r[:2] for r in rows] == [(1, "a b c d e f"), (3, "other words")] and rows[0][2] in ("x", "v")
    assert simhash.near_duplicates(docs, key="doc.id", text="my text").count() == 5


def test_empty(make_docs):
    assert simhash.near_duplicates(make_docs([(1, "x")]).limit(0)).collect() == []
