"""Spelling variants against all pairs by edit distance, with divided blocks, and the query's digest by brute force."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spliceloom.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    """Exactly one inserted, deleted or replaced character."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) >= len(b)) :] == b[p + (len(b) >= len(a)) :]


def brute_pairs(words):
    """Candidates share what one deletion leaves; verified by ``near``."""
    holes = defaultdict(set)
    for w in words:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
    return {(a, b) for ws in holes.values() for a in ws for b in ws if a < b and near(a, b)}


def brute(count, ratio=5):
    of = defaultdict(list)
    for a, b in brute_pairs(count):
        of[a].append(b)
        of[b].append(a)
    form = {}
    for w in count:
        top = min(of[w], key=lambda x: (-count[x], x), default=None)
        form[w] = top if top is not None and count[top] >= ratio * count[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(of[w]), count[form[w]] if form[w] else 0) for w, n in count.items())


def rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


WORDS = Counter(
    {"abcdef": 3000, "abcdex": 500, "abcxex": 90, "abxxex": 10, "bcdef": 7, "abcdefg": 5, "aabcdef": 5, "abdcef": 600, "a": 9, "b": 50, "ab": 3, "": 2, "é": 4, "éa": 1, "aaaaaa": 6, "aaaaaaa": 30, "aaaaaaaa": 150, "aaaaaab": 150}
)
WORDS.update({f"stem{x}{y}": 5 + ord(x) * ord(y) % 90 for x in "abcdefghijkl" for y in "abcdefghijklm"})
WORDS.update({f"pre{x}fix{y}": 5 + ord(x) * len(y) * 37 % 70 for x in "abcdefgh" for y in ["", "a", "b", "ab", "ba", "éç"]})


@pytest.mark.parametrize("block", [1, 4, 40, 10_000])
def test_equals_all_pairs(spark, block):
    df = spark.createDataFrame(list(WORDS.items()), "word string, n long")
    pairs = [tuple(r) for r in spelling.near_pairs(df, block).select("a", "b").collect()]
    assert len(pairs) == len(set(pairs))
    assert {tuple(sorted(p)) for p in pairs} == brute_pairs(WORDS) == {(a, b) for a in WORDS for b in WORDS if a < b and near(a, b)}
    assert rows(spelling.group(df, block=block)) == brute(WORDS)


def test_blocks_are_bounded(spark):
    """Words that all share their first half: what is compared does not grow with the square of the block."""
    df = spark.createDataFrame([("common" + format(i * 2654435761 % 2**24, "06x"), 5) for i in range(3000)], "word string, n long")
    assert spelling.near_pairs(df, 20).count() == len(brute_pairs([r.word for r in df.collect()]))


def test_counts(spark, make_docs):
    texts = ["Straße straße STRASSE ÀÉ×÷ñandu ñANDU", None, "", "naïveté-Naïveté_naïveté 0x", "abcdef" * 300, "x\ny"] * 5
    got = {(r.word, r.n) for r in spelling.word_counts(make_docs(texts, extra=True)).collect()}
    want = Counter(w.translate({c: c + 32 for c in range(65, 91)}) for t in texts if t for w in re.findall("[A-Za-zÀ-ÿ]+", t))
    assert got == {(w, n) for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert spelling.group(spelling.word_counts(make_docs([]))).count() == 0
    assert spelling.group(spelling.word_counts(make_docs([None, ""]))).count() == 0


def test_query(spark):
    count = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{r.doc_id}:{w}".encode())
            count[w if h % 199 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    got = queries.op13_spelling(spark, SF)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert rows(got) == brute({w: n for w, n in count.items() if len(w) >= 6 and n >= 5})
    assert got.where(F.col("form").isNotNull()).count() > 0
