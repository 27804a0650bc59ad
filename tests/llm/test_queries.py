"""The thin digests of the contract queries that other tests take from the operators alone."""

import hashlib

from test_simhash import brute_components, brute_fp
from test_suffix_match import brute as brute_hits

from spliceloom.llm import queries

SF = "/root/testdata/sf0.001"


def test_op8_digest(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute_hits(docs, items)}
    got = queries.op8_suffix_match(spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert {tuple(r) for r in got.collect()} == want


def test_op9_digest(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: brute_fp(t) for i, t in docs.items()}
    best = brute_components(list(fps.items()))
    got = queries.op9_simhash(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == {(i, f"{fps[i]:016x}", best[i]) for i in docs}


def test_schemas(spark):
    first = {
        "op1_ppm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        "op2_ogg": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
        "op4_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
        "op5_token_count": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op6_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op10_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    }
    for name, want in first.items():
        found = dict(queries.QUERIES[name](spark, SF).dtypes)
        for column in want.split(", "):
            c, kind = column.split(" ")
            assert found[c] == kind, (name, c)


def test_held_out_rows_do_not_teach(spark):
    """Changing labels and languages of held-out rows changes no score."""
    from pyspark.sql import functions as F

    from spliceloom.llm import langid, toxicity
    from spliceloom.llm.common import crc_mod

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    learn, held = crc_mod("doc_id", 3) != 1, crc_mod("doc_id", 3) == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = (sorted(map(tuple, toxicity.score(docs, toxicity.fit(docs, x, learn)).collect())) for x in (labels, other))
    assert a == b
    changed = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    assert langid.fit(changed, learn)[0] == langid.fit(docs, learn)[0]
    assert (langid.fit(changed, learn)[1] == langid.fit(docs, learn)[1]).all()
