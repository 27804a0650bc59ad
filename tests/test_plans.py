import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spliceloom.config import RunConfig
from spliceloom.operators import annotate, isoforms, report
from spliceloom.plans import cli, mock, pipeline
from spliceloom.sources import reads, tables, writer
from spliceloom.streaming import reads as stream

GENOME = mock.pseudo_genome()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("reads")
    df = mock.reads(mock.allotted(spark, isoforms.mock_ratios(), 1500), "form", "read_ix", GENOME, umis_per_form=5)
    writer.write_pairs(df, str(d / "a_r1.fasta"), str(d / "a_r2.fasta"))
    (d / "genome.fa").write_text(">g\n" + "\n".join(GENOME[i : i + 70] for i in range(0, len(GENOME), 70)))
    return d


def test_formats():
    assert [reads.data_type(f"x{e}") for e in (".fasta", ".fa", ".fastq.gz", ".fq")] == [("fasta", False), ("fasta", False), ("fastq", True), ("fastq", False)]
    for bad in ("x.txt", "x.FASTA", "x.gz"):
        with pytest.raises(ValueError):
            reads.data_type(bad)
    with pytest.raises(ValueError):
        reads.check_pair("a.fa", "a.fq")


def test_fastq_gzip_pairs(spark, tmp_path):
    for name, n in (("r1", 3), ("r2", 2)):
        with gzip.open(tmp_path / f"{name}.fastq.gz", "wt") as f:
            f.write("@a x\nACGT\n+\nIIII\n")
        with gzip.open(tmp_path / f"{name}.fastq.gz", "at") as f:  # a second gzip member
            for i in range(1, n):
                f.write(f"@b{i}\nGG{'T' * i}\n+\n{'I' * (2 + i)}\n")
    rows = reads.read_pairs(spark, str(tmp_path / "r1.fastq.gz"), str(tmp_path / "r2.fastq.gz")).orderBy("read_ix").collect()
    assert [(r.read_ix, r.id, r.r1, r.r2) for r in rows] == [(0, "a", "ACGT", "ACGT"), (1, "b1", "GGT", "GGT")]
    (tmp_path / "bad.fq").write_text("@a\nAC\n+\nI\n")
    with pytest.raises(ValueError):
        list(reads.records(str(tmp_path / "bad.fq")))


def test_run_and_compare(spark, files, tmp_path):
    out = []
    for sample, model in (("one", "auto-model"), ("two", "cluster-model")):
        args = cli.parser().parse_args(["run", "-1", str(files / "a_r1.fasta"), "-2", str(files / "a_r2.fasta"), "-g", str(files / "genome.fa"), "-o", str(tmp_path / "runs" / sample), "-u", model])
        out.append(pipeline.run(spark, cli.config(args)))
    back = tables.read_reads(spark, out[0]["reads"])
    assert Path(out[0]["reads"]).is_dir()
    assert back.count() == 1500 and back.columns == list(tables.READ_COLUMNS)
    assert back.where("splice_category = 'D1_A3'").count() > 0
    summary = tables.read_summary(spark, out[0]["summary"])
    assert summary.where("umi_family is null").isEmpty() and summary.where("alternative_d1_used_common = 'None'").count() > 0
    params = json.loads(Path(out[0]["params"]).read_text())
    assert params["strain"] == "nl43" and params["reads"] == {"pairs": 1500, "too_short": 0, "homopolymer": 0}
    text = Path(out[0]["report"]).read_text()
    assert "window.links" in text and "Association: p = " in text and text.count("<svg") > 10 and "genome" not in params
    got = pipeline.compare(spark, str(tmp_path / "runs"), str(tmp_path / "all"))
    assert tables.read_features(spark, str(tmp_path / "all" / "run_features.csv")).count() == 2
    assert "percent_spliced" in Path(got["report"]).read_text()
    pooled = annotate.annotate(tables.read_samples(spark, str(tmp_path / "all")))
    assert {r.id for r in pooled.select("id").distinct().collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        tables.scan_runs(spark, str(files))


def test_run_without_a_genome(spark, files, tmp_path):
    args = cli.parser().parse_args(["run", "-1", str(files / "a_r1.fasta"), "-2", str(files / "a_r2.fasta"), "-o", str(tmp_path / "out"), "--single"])
    config = cli.config(args)
    assert len(config.genome) == 8966
    got = pipeline.run(spark, config, single=args.single)
    assert Path(got["reads"]).is_file() and tables.read_reads(spark, got["reads"]).count() == 1500
    assert not list((tmp_path / "out").glob("*.parts"))


def test_golden_search_in_the_built_in_genome():
    from spliceloom.functions import fuzzy

    assert fuzzy.find(reads.genome().encode(), b"TTTTCCTAGGATATGGCTCCATAACTTAGGACAA", 2) == (4913, 4947, 0)


def test_own_isoform_lookup(spark, files, tmp_path):
    mine = isoforms.lookup(spark).withColumn("splice_cat2", F.when(F.col("SpliceForm") == "D1_A3", "my form").otherwise(F.col("splice_cat2")))
    tables._write(mine, str(tmp_path / "mine.csv"), True, nullValue="NA")
    args = ["run", "-1", str(files / "a_r1.fasta"), "-2", str(files / "a_r2.fasta"), "-o", str(tmp_path / "r" / "one"), "--isoforms"]
    done = pipeline.run(spark, cli.config(cli.parser().parse_args([*args, str(tmp_path / "mine.csv")])))
    assert "my form" in Path(done["report"]).read_text() and "my form" in Path(done["isoforms"]).read_text()
    pooled = pipeline.compare(spark, str(tmp_path / "r"), str(tmp_path / "all"), str(tmp_path / "mine.csv"))
    assert "my form" in Path(pooled["pooled"]).read_text()
    tables._write(mine.unionByName(mine.limit(1)), str(tmp_path / "twice.csv"), True, nullValue="NA")
    with pytest.raises(ValueError):
        pipeline.known_isoforms(spark, str(tmp_path / "twice.csv"))


def test_mock_files_with_ratios(spark, tmp_path, monkeypatch):
    (tmp_path / "ratios.csv").write_text("SpliceForm,ratio\nD1_A3,0.75\nnoD1,0.25\n")
    assert tables.read_ratios(spark, str(tmp_path / "ratios.csv")) == {"D1_A3": 0.75, "noD1": 0.25}
    cli.main(["mock", "-n", "40", "--ratios", str(tmp_path / "ratios.csv"), "--format", "fastq.gz", "-o", str(tmp_path / "m")])
    rows = reads.read_pairs(spark, str(tmp_path / "m/mock_r1.fastq.gz"), str(tmp_path / "m/mock_r2.fastq.gz")).collect()
    assert len(rows) == 40 and sum("D1_A3" in r.id for r in rows) == 30


def test_rejected_pairs_are_counted(spark):
    from spliceloom.operators import chain

    run_ = "A" * 14
    rows = spark.createDataFrame([("ACGTACGTAC", "C" * 3 + "G" * 11 + "AT"), ("AC", "A" * 20), ("ACG" + run_ + "CC", "ACGT" * 5), ("TTTTACGTAC", "ACGT" * 5), ("ACGTACGTAC", "ACGT" * 5)], "r1 string, r2 string")
    got = rows.agg(*chain.reject_counts("ACGT", 0)).first().asDict()
    assert got == {"pairs": 5, "too_short": 1, "homopolymer": 2, "header": 1}


def test_stage_timings(spark, files, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("SPLICELOOM_TIMING", "1")
    args = cli.parser().parse_args(["run", "-1", str(files / "a_r1.fasta"), "-2", str(files / "a_r2.fasta"), "-o", str(tmp_path / "t")])
    pipeline.run(spark, cli.config(args))
    assert len([x for x in capsys.readouterr().err.splitlines() if x.endswith(" s") and ": " in x]) == 9


def test_long_frames_are_cut_on_the_page_alone(spark, tmp_path):
    df = spark.range(30).selectExpr("cast(id as string) as splice_cat2", "id as n")
    text = pipeline.page("x", {"isoforms": df}, str(tmp_path), {}, most_rows=10)
    assert text.count("<tr>") == 11 and "<td>29</td>" in text and "<td>5</td>" not in text
    assert len((tmp_path / "isoforms.csv").read_text().split()) == 31


def test_files_on_other_file_systems(tmp_path):
    from spliceloom.sources import files as f

    (tmp_path / "a b.fa.gz").write_bytes(gzip.compress(b">x\nAC\n"))
    assert f.local("hdfs://host/x") is None and f.local("file:/x%20y") == "/x y"
    for path in (f"{tmp_path}/a b.fa.gz", f"file://{tmp_path}/a%20b.fa.gz"):
        assert next(reads.records(path))[2] == "AC"


@pytest.mark.parametrize("model", ["auto-model", "cluster-model"])
def test_stream_equals_batch(spark, files, tmp_path, model):
    """After every micro-batch, with a restart between; only the categories that a batch touches are called anew."""
    config = RunConfig(genome=GENOME, family_model=model)
    rows = reads.read_pairs(spark, str(files / "a_r1.fasta"), str(files / "a_r2.fasta")).select("read_ix", "id", "r1", "r2")
    parts = [rows.where("read_ix % 2 = 0"), rows.where("read_ix % 2 = 1 and read_ix < 700"), rows.where("read_ix % 2 = 1 and read_ix >= 700").limit(3)]
    at = {x: str(tmp_path / x) for x in ("in", "events", "ck1", "families", "ck2")}
    cols = ["read_ix", "final_category", "umi", "umi_family", "umi_family_size", "umi_family_fraction", "umi_model_used", "umi_unique_count"]
    seen = None
    for k, part in enumerate(parts):
        part = spark.createDataFrame(part.collect(), part.schema)
        seen = part if seen is None else seen.unionByName(part)
        part.coalesce(1).write.mode("append").parquet(at["in"])
        stream.start(stream.stream_events(spark, at["in"], config), at["events"], at["ck1"]).awaitTermination(120)
        stream.start_families(spark, at["events"], at["families"], at["ck2"], config).awaitTermination(240)
        a, b = stream.families_so_far(spark, at["events"], at["families"]), pipeline.call_families(seen, config)
        assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))
        if k:
            called = spark.read.parquet(f"{at['families']}/choices").groupBy("batch").count().collect()
    assert len(called) == 3 and max(called, key=lambda r: r.batch)["count"] <= 3
    # a batch that is run once more after a failure leaves everything as it is
    last = max(r.batch for r in called)
    stored = spark.read.parquet(f"{at['families']}/counts/batch={last}").select("final_category", "umi", "n")
    again = spark.createDataFrame(stored.collect(), stored.schema)
    stream._update(again, last, at["families"], config)
    assert sorted(map(str, stream.families_so_far(spark, at["events"], at["families"]).select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_header_filter_and_short_reads(spark):
    rows = spark.createDataFrame([(0, "a", "ACGTTTTTGGCC", "A" * 14 + "CC"), (1, "b", "ACG", "A" * 20), (2, "c", "TTTTACGT", "ACGTACGTACGTACGT")], "read_ix long, id string, r1 string, r2 string")
    config = RunConfig(genome=GENOME, header="ACGT", distance=0)
    assert [r.sequence_id for r in pipeline.call_families(rows, config).select("sequence_id").collect()] == ["a"]


def test_mock_padding_and_mutation(spark):
    df = spark.range(200).select(mock.padded(F.lit("ACG")).alias("p"), mock.mutated(F.lit("ACGTACGTAC"), 0.3, F.col("id")).alias("m"))
    rows = df.collect()
    assert all(len(r.p) == 300 and r.p.startswith("ACG") and len(r.m) == 10 for r in rows)
    changed = sum(a != b for r in rows for a, b in zip(r.m, "ACGTACGTAC")) / 2000
    assert 0.25 < changed < 0.35
