import re

import pytest

from spliceloom.llm import suffix_match

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[x]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(docs, bench, **more):
    return sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r.hit_items or [])) for r in suffix_match.matches(docs, bench, **more).collect()), key=str)


def test_whole_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.collect()])
    assert sum(bool(x[2]) for x in want) > 5
    assert got(docs, bench) == want
    assert suffix_match.decontaminate(docs, bench).count() == sum(not x[2] for x in want)


@pytest.mark.parametrize("block", [suffix_match.BLOCK_BYTES, 30])
def test_edge_cases(spark, make_docs, block):
    item = "Alpha beta gamma delta eps zeta eta theta iota kappa lambda mu"
    items = [(1, item), (2, item), (3, "Ünder  zwei"), (4, None), (5, "..."), (6, "a a a"), (7, "x " * 15), (None, "short one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", item, item + " " + item, item[:-20], "ünder-zwei ünder zwei", "ÜNDER ZWEI", "a a a a a b a a", "x " * 40, "so " * 5000 + item.upper(), "short", "one short one", item, ("alpha " * 3 + item + "! ") * 50]
    docs = make_docs([*texts, (None, item), (2, item)], extra=True)
    want = brute([*enumerate(texts), (None, item), (2, item)], items)
    assert got(docs, bench, block_bytes=block) == want
    kept = suffix_match.decontaminate(docs, bench, block_bytes=block)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not x[2] for x in want)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(make_docs(["some text"]), none) == [(0, 2, 0, [])]
    assert got(make_docs(["x"]).limit(0), none) == []


def test_longest_match_exceeds_the_window():
    items = suffix_match.Items([1], ["a b c d e f g h i j k l"], window=3)
    from spliceloom.llm.common import utf8
    import pyarrow as pa

    raw, off = utf8(pa.array(["z b c d e q"]))
    assert suffix_match.scan_shard(raw, off, items)["longest"].tolist() == [4]


def test_longest_match_of_each_row_of_a_shard():
    import pyarrow as pa
    from spliceloom.llm.common import utf8

    item = "a b c d e f g h i j k l"
    texts = ["z b c d e q", "z b c d e f g q", "a b c", "y k l", "x b c d x b c d e f x"]
    got = suffix_match.scan_shard(*utf8(pa.array(texts)), suffix_match.Items(["i"], [item], 3))
    assert got["longest"].tolist() == [4, 6, 3, 0, 5]
    for text, want in zip(texts, [4, 6, 3, 0, 5]):  # whatever else the shard holds
        assert suffix_match.scan_shard(*utf8(pa.array([text])), suffix_match.Items(["i"], [item], 3))["longest"].tolist() == [want]


def test_many_blocks_are_one_step(spark, make_docs):
    """A hundred blocks of items: one Python function in the plan, results as with one block."""
    rng = __import__("random").Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for i in range(100)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [" ".join(rng.choice(vocabulary) for _ in range(200)) + " " + rng.choice(items)[1] + " " + rng.choice(items)[1] for _ in range(40)] + [None, ""]
    docs = make_docs(texts)
    found = suffix_match.matches(docs, bench, window=4, block_bytes=1)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = brute(list(enumerate(texts)), items, 4)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r.hit_items or [])) for r in found.collect()), key=str) == want
    one = {r.doc_id: (r.longest, r.spans) for r in suffix_match.matches(docs, bench, window=4).collect()}
    assert {r.doc_id: (r.longest, r.spans) for r in found.collect()} == one
    assert suffix_match.decontaminate(docs, bench, window=4, block_bytes=1).count() == sum(not x[2] for x in want)


def test_awkward_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 0), (2, "none", 1)], "`doc.id` long, `te``xt` string, hits int")
    bench = spark.createDataFrame([(9, "b c d", 0)], "`item.id` long, `it text` string, doc_id int")
    more = {"window": 3, "text": "te`xt", "item_key": "item.id", "item_text": "it text"}
    assert [r.doc_id for r in suffix_match.matches(docs, bench, key="doc.id", **more).collect() if r.n_hit] == [1]
    kept = suffix_match.decontaminate(docs, bench, **more)
    assert kept.columns == docs.columns and [r[0] for r in kept.collect()] == [2]
