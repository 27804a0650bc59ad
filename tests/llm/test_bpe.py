import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

from spliceloom.llm import bpe

PATH = bpe.default_path()
EDGE = ["", " ", "Hello, World!", "aaaa aaaaa aaaaaaaaaaaaaaa", "don't I'LL we've", "naïve ÉCOLE été", "ΣΑΣ Σ ΟΔΟΣ", "é x́", "日本語 テスト 漢字", "😀😀 👍🏽", "a b c　d\x1cE\x85F", "<|startoftext|>hi <|endoftext|> there<|endoftext|", "<|ENDOFTEXT|>", "İstanbul ŉ ſ K", "\x00\x01\x7f\x80", "１２３ ½ ² 12345", "___--==++ ''s 's't", "﻿bom ​zero", "नमस्ते ไทย", "x" * 3000, "ab" * 1500, "\U000e0001 �", "١٢٣ ٣"]


def library(texts):
    t = Tokenizer.from_file(PATH)
    t.no_truncation(), t.no_padding()
    out = []
    for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False):
        out.append((e.ids, t.decode(e.ids, skip_special_tokens=False)))
    return out


def mine(texts, **more):
    return [(np.frombuffer(i, "<u4").tolist(), d) for i, d in bpe.Encoder(PATH, **more).encode(texts)]


def test_edge_texts_equal_the_library():
    for text, a, b in zip(EDGE, mine(EDGE), library(EDGE)):
        assert a == b, text
    assert mine([None]) == [([], "")]
    assert mine(EDGE, cache_words=3) == mine(EDGE)


def test_random_texts_equal_the_library():
    rng = random.Random(1)
    letters = "aabcdeeinorstthéßñ'´ .,!-_09\n\t<|>ÀÑ" + "Σшд漢á"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(3000)]
    assert mine(texts) == library(texts)


def test_one_at_a_time_gives_the_same_words():
    """The path for vocabularies whose merges are not in order of birth, on one that is."""
    v = bpe.Vocabulary(PATH)
    assert v.ordered
    words = [w.encode() for w in ["aaaaaaa", "banana", "mississippi", "thethethe", "nnnn"]]
    a, at = bpe.encode_words(words, v)
    v.ordered = False
    b, bt = bpe.encode_words(words, v)
    assert a.tolist() == b.tolist() and at.tolist() == bt.tolist()


def test_long_texts_are_taken_in_steps(monkeypatch):
    texts = ["some words and more, " * 40 + "<|endoftext|>" + "né " * 30, "", "one", "x" * 90, None]
    want = library(texts)
    for step in (1, 3, 50):
        monkeypatch.setattr(bpe, "STEP_WORDS", step)
        for most in (0, 2, 1000):
            assert mine(texts, cache_words=most) == want


def test_special_strings_of_the_file(tmp_path):
    """Special strings are the file's own, whatever they look like, the longer first."""
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    for i, t in enumerate(spec["added_tokens"][:2]):
        spec["model"]["vocab"].pop(t["content"], None)
        t["content"] = ["[stop]", "[stop][stop]"][i]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    encoder = bpe.Encoder(str(tmp_path / "v.json"))
    special = encoder.v.special
    for text, n in (("a [stop] b", 1), ("a[stop][stop]b", 1), ("a [stop][stop][stop]", 2), ("[stp]", 0)):
        ids = np.frombuffer(next(encoder.encode([text]))[0], "<u4").tolist()
        assert sum(i in special.values() for i in ids) == n, text


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    want = {r.doc_id: (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(d.encode()).hexdigest()) for r, (i, d) in zip(rows, library([r.text for r in rows]))}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoded(docs).collect()} == want


def test_edge_rows(make_docs):
    docs = make_docs([None, "", "Hi", (None, "Hi"), (2, "Hi"), (9, "word " * 30_000)], extra=True)
    got = {(r.doc_id, r.n_tokens, r.decoded) for r in bpe.encoded(docs, with_ids=True).collect()}
    assert (0, 0, "") in got and (1, 0, "") in got and (2, 1, "hi</w>") in got and (None, 1, "hi</w>") in got
    assert (9, 30_000, " ".join(["word</w>"] * 30_000)) in got
    assert bpe.encoded(docs.limit(0)).collect() == []


def test_decode_inverts():
    v = bpe.Vocabulary(PATH)
    ids, text = next(bpe.Encoder(PATH).encode(["Some words, née <|endoftext|>"]))
    assert bpe.decode(ids, v) == text
