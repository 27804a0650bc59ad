import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spliceloom.llm import ppm, queries


def brute(rows):
    """Word counts, and PPM with explicit sets of excluded symbols; rows are (id, text, learn)."""
    trie, count = defaultdict(Counter), Counter()
    seq = lambda t: bytes([0xFE] * 5) + (t or "").encode() + b"\xff"
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())), None]
    for _, t, learn in rows:
        if learn:
            b = seq(t)
            for i in range(5, len(b)):
                for o in range(6):
                    trie[b[i - o : i]][b[i]] += 1
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for i, t, _ in rows:
        b, lp = seq(t), 0.0
        for k in range(5, len(b)):
            out_of = set()
            for o in range(5, -1, -1):
                c = {s: m for s, m in trie.get(b[k - o : k], {}).items() if s not in out_of}
                if not c:
                    continue
                total, d = sum(c.values()), len(c)
                if b[k] in c:
                    lp += math.log10(c[b[k]] / (total + d))
                    break
                lp += math.log10(d / (total + d))
                out_of |= set(c)
            else:
                lp -= math.log10(256 - len(out_of))
        w = tokens(t)
        out.append((i, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), lp))
    return sorted(out, key=str)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-6) and a[5] == pytest.approx(b[5], rel=1e-6), (a, b)


FIELDS = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    same(sorted((tuple(r[f] for f in FIELDS) for r in ppm.score(docs, F.col("learn"), piece_bytes=20_000).collect()), key=str), brute(rows))


@pytest.mark.parametrize("learn", [True, False, None])
def test_edge_cases(make_docs, learn):
    texts = [None, "", "a", "aaaaaa", "Ab aB\tAB", "né né 😀", (None, "aaaa"), (3, "aaaaaa"), "xyz " * 30_000]
    docs = make_docs(texts, extra=True)
    rows = [(r.doc_id, r.text, bool(learn) or (learn is None and r.doc_id in (3, 4))) for r in docs.collect()]
    flag = F.lit(learn) if learn is not None else F.col("doc_id").isin(3, 4)
    same(sorted((tuple(r[f] for f in FIELDS) for r in ppm.score(docs, flag).collect()), key=str), brute(rows))


def test_empty(make_docs):
    assert ppm.score(make_docs(["x"]).limit(0), F.lit(True)).collect() == []


def test_held_out_texts_are_predicted_well(spark):
    got = queries.op1_ppm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), (F.sum(F.col("bits_per_byte") * F.col("n_bytes")) / F.sum("n_bytes")).alias("bpb")).first()
    print(got)
    assert got.bpb < 3.5


def test_total_probability_is_one(spark):
    """Over all next bytes, in a context that has been seen, the probabilities add up to one."""
    import numpy as np

    rows = [("abracadabra abra",), ("abba",)]
    want = []
    for ctx in (b"\xfe\xfe\xfeab", b" abra", b"zzzzz", b"\xfe\xfe\xfe\xfe\xfe"):
        for s in range(256):
            want.append(int.from_bytes(ctx + bytes([s]), "big"))
    from pyarrow import array
    from spliceloom.llm.common import utf8

    seen, n = np.unique(ppm.grams(*utf8(array([r[0] for r in rows])))[0], return_counts=True)
    count = dict(zip(seen.tolist(), n.tolist()))
    df = spark.createDataFrame([(0, k, count.get(k, 0)) for k in {*want, *count}], "shard int, key long, n long")
    value = {r.key: 10**r.value for r in ppm.gram_values(df).collect()}
    for i in range(0, len(want), 256):
        assert sum(value[k] for k in want[i : i + 256]) == pytest.approx(1)


@pytest.mark.parametrize("pieces,coarse", [(20_000, 1024), (20_000, 5), (2_000, 16)])
def test_shards_follow_the_input(make_docs, monkeypatch, pieces, coarse):
    """As many shards as pieces, and the same scores however they are divided."""
    import random

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "then", "there", "a", "Tea", "nothing"]) for _ in range(rng.randint(1, 400))) for _ in range(120)]
    docs = make_docs(texts)
    rows = [(i, t, i % 3 > 0) for i, t in enumerate(texts)]
    monkeypatch.setattr(ppm, "COARSE_SHARDS", coarse)
    seen = []
    shard_of = ppm._requests
    monkeypatch.setattr(ppm, "_requests", lambda packed, shards: seen.append((packed.count(), shards)) or shard_of(packed, shards))
    same(sorted((tuple(r[f] for f in FIELDS) for r in ppm.score(docs, F.col("doc_id") % 3 > 0, piece_bytes=pieces).collect()), key=str), brute(rows))
    assert seen == [(seen[0][0], max(12, seen[0][0]))] and seen[0][0] >= sum(map(len, texts)) // pieces


def test_a_common_beginning_is_divided():
    import numpy as np

    key = np.array([int.from_bytes(b" the" + bytes([a, b]), "big") for a in range(97, 123) for b in range(32, 123)])
    assert len(set((ppm._shard_of(key, ppm.GRAMS, 1024)).tolist())) == 1
    shard, n = np.unique(ppm._shard_of(key, ppm.GRAMS, 16 * 1024), return_counts=True)
    assert len(shard) > 10 and n.max() < len(key) / 4 and (shard % 2 == 0).all()
