"""Command line: ``python -m spliceloom.plans.cli run|compare|mock``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..config import Assay, FamilyModel, RunConfig
from ..operators import isoforms
from ..sources import files, reads, tables, writer
from . import mock, pipeline


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spliceloom")
    sub = top.add_subparsers(dest="what", required=True)
    r = sub.add_parser("run", help="read pairs to events, families, summary and report")
    r.add_argument("-q", "--query", default="nl43", help="strain")
    r.add_argument("-d", "--distance", type=int, default=1)
    r.add_argument("-u", "--umiFamilyModel", type=FamilyModel, choices=list(FamilyModel), default=FamilyModel.AUTO)
    r.add_argument("--umiMinFraction", type=float, default=0.005)
    r.add_argument("--umiAutoNeighborRisk", type=float, default=0.05)
    r.add_argument("--headerMatch")
    r.add_argument("-1", "--file1", dest="r1", required=True)
    r.add_argument("-2", "--file2", dest="r2", required=True)
    r.add_argument("-a", "--assay", type=Assay, choices=list(Assay), default=Assay.RANDOM_REVERSE)
    r.add_argument("-o", "--output", help="folder; that of the first file if not given")
    r.add_argument("-g", "--genome", help="FASTA file of the reference genome; the built-in one if not given")
    r.add_argument("--single", action="store_true", help="the per-read table as one file")
    r.add_argument("--isoforms", help="CSV file of an isoform lookup in place of the built-in one")
    c = sub.add_parser("compare", help="summaries of several runs")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output", required=True)
    c.add_argument("--isoforms", help="CSV file of an isoform lookup in place of the built-in one")
    m = sub.add_parser("mock", help="mock read pairs")
    m.add_argument("-n", "--reads", type=int, default=10_000)
    m.add_argument("-g", "--genome", help="FASTA file of the genome that second reads come from; the built-in one if not given")
    m.add_argument("--ratios", help="CSV file of forms and their shares (SpliceForm, ratio)")
    m.add_argument("--format", choices=["fasta", "fa", "fastq", "fq", "fasta.gz", "fastq.gz"], default="fasta")
    m.add_argument("-o", "--output", required=True)
    return top


def config(a: argparse.Namespace) -> RunConfig:
    return RunConfig(a.query, a.distance, a.umiFamilyModel, a.umiMinFraction, a.umiAutoNeighborRisk, header=a.headerMatch, r1=a.r1, r2=a.r2, assay=a.assay, out=a.output or a.r1.split(",")[0].rpartition("/")[0] or ".", genome=reads.genome(a.genome), isoforms=a.isoforms)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    # finished stages' checkpoints go when nothing refers to them any more
    spark = SparkSession.builder.appName("spliceloom").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    if a.what == "run":
        done = pipeline.run(spark, config(a), single=a.single)
    elif a.what == "compare":
        done = pipeline.compare(spark, a.input, a.output, a.isoforms)
    else:
        files.make_folder(spark, a.output)
        done = {"r1": f"{a.output}/mock_r1.{a.format}", "r2": f"{a.output}/mock_r2.{a.format}"}
        ratios = tables.read_ratios(spark, a.ratios) if a.ratios else isoforms.mock_ratios()
        parts = {k: f"{a.output}/_mock_{k}.{a.format}" for k in done}
        writer.write_pairs(mock.reads(mock.allotted(spark, ratios, a.reads), "form", "read_ix", reads.genome(a.genome)), parts["r1"], parts["r2"])
        for k, path in done.items():
            writer.as_one_file(spark, parts[k], path)
    for name, path in done.items():
        print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
