"""The pipeline's stages against brute force, stage by stage on its own input, and the entry without the corpus part."""

import hashlib
import os
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from test_bpe import library
from test_line_spread import brute as brute_lines
from test_near_sets import brute_kept
from test_suffix_match import brute as brute_hits

import corpus_pipeline
from spliceloom.llm import line_spread

SF = "/root/testdata/sf0.01"
ROOT = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each, every stage written and read again as the check does."""
    at = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(at / str(k)))
        out.append(spark.read.parquet(str(at / str(k))))
    return out


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding"]


def test_language_stage(stages):
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in stages[:2])
    assert set(after) <= set(before) and all(before[i] == t for i, t in after.items())
    lost = [before[i] for i in set(before) - set(after)]
    assert len(lost) <= 0.01 * len(before)
    assert all(i in after for i, t in before.items() if t and sum(c.isalpha() for c in t) > 200)


def test_line_stage(stages):
    before = [(r.doc_id, r.text, r.source) for r in stages[1].collect()]
    assert sorted(((r.doc_id, r.text) for r in stages[2].collect()), key=str) == brute_lines(before, line_spread.MIN_SITES)


def test_near_copy_stage(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    want = {i: before[i] for i in brute_kept(before)}
    assert {r.doc_id: r.text for r in stages[3].collect()} == want


def test_leak_stage(spark, stages):
    before = [(r.doc_id, r.text) for r in stages[3].collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {x[0] for x in brute_hits(before, items) if not x[2]}
    assert {r.doc_id for r in stages[4].collect()} == clean


def test_encoding_stage(stages):
    before = [(r.doc_id, r.text) for r in stages[4].collect()]
    want = {i: (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(d.encode()).hexdigest()) for (i, _), (ids, d) in zip(before, library([t for _, t in before]))}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[5].collect()} == want


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_awkward_documents_pass_all_stages(spark, make_docs, tmp_path):
    docs = make_docs([None, "", "12 34", "the cat\nthe dog", "the cat\nthe dog", (None, "the cat"), (3, "the cat\nthe dog"), "word " * 30_000])
    for data in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            data = stage(spark, data, SF)
        data.collect()


def test_entry_without_the_corpus_part(tmp_path):
    for name in ("__spark_entry__.py", "spliceloom"):
        src = ROOT / name
        (shutil.copytree if src.is_dir() else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "spliceloom/llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'read_split' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_corpus_part():
    for p in (ROOT / "spliceloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
