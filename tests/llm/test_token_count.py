import random

import pytest

from spliceloom.llm import queries, token_count

PATH = token_count.default_path()


@pytest.fixture(scope="module")
def tokenizer():
    return token_count.load(PATH)


def texts():
    rng = random.Random(2)
    alphabet = ["a", "the ", "  ", "\n", "\n\n ", "é", "漢字", "😀", "'s", "123", "!!", "<|endoftext|>", "<|endof", "text|>", " word", "\t"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3000))) for _ in range(60)]
    return out + ["x" * 5000, " " * 5000, "\n" * 3000 + "a", "ab " * 4000, "<|endoftext|>" * 500, "a" * 3000 + " b" * 3000, "1" * 4000 + "!" * 4000, "word" + " " * 3000 + "word"]


@pytest.mark.parametrize("chunk,overlap,margin", [(200, 20, 16), (300, 64, 64), (1000, 256, 64)])
def test_chunks_give_the_whole_texts_count(tokenizer, chunk, overlap, margin):
    for t in texts():
        assert token_count.count_long(tokenizer, t, chunk, overlap, margin) == len(tokenizer.encode(t, add_special_tokens=False).ids), t[:60]


def test_whole_table(spark, tokenizer):
    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    want = {r.doc_id: (len(r.text.encode()), len(tokenizer.encode(r.text, add_special_tokens=False).ids)) for r in rows}
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in queries.op5_token_count(spark, d).collect()}
    assert got == want


def test_edge_rows(make_docs, tokenizer):
    docs = make_docs([None, "", "hi there", (None, "hi"), (2, "hi"), (9, "some word, " * 20_000)], extra=True)
    got = sorted(((r.doc_id, r.n_tokens, r.over_limit) for r in token_count.counts(docs).collect()), key=str)
    n = len(tokenizer.encode("some word, " * 20_000, add_special_tokens=False).ids)
    assert got == sorted([(0, 0, False), (1, 0, False), (2, 2, False), (None, 1, False), (2, 1, False), (9, n, True)], key=str)
    assert token_count.counts(docs.limit(0)).collect() == []


@pytest.fixture(scope="module")
def spec():
    import json

    with open(PATH, encoding="utf-8") as f:
        return json.load(f)


def test_pretokens_give_the_librarys_counts(tokenizer, spec):
    rng = random.Random(7)
    usual = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0x180))]
    other = usual + ["\x85", "\xa0", "\u2003", "\x1c", "漢", "é", "🙂", "١", "\ufeff", "<|endoftext|>"]
    counter = token_count.Pretokens(tokenizer, spec, 500)
    seen = {True: 0, False: 0}
    for _ in range(4000):
        alphabet = rng.choice((usual, usual, other, [" ", "  ", "\n", "a", "'", "'s", "'ll", "9", "½", "\xad", "ß", "!", "\t"]))
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        got = counter.count(t)
        seen[got is None] += 1
        assert got is None or got == len(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)
    assert min(seen.values()) > 300
    for c in usual:  # each by itself and beside others
        for t in (c, f"a{c}b", f" {c} {c}{c} 1{c}"):
            assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def test_other_files_go_to_the_library(tokenizer, spec):
    for more in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        assert token_count.Pretokens(tokenizer, spec | more).count("some words") is None
