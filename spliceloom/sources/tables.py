"""Text tables of the analysis: per-read TSV, summaries, run folders, lookups; reading and writing."""

from __future__ import annotations

import base64
import csv
import io
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.isoforms import COLUMNS as ISOFORM_COLUMNS
from ..operators.summary import COLUMNS as SUMMARY_COLUMNS
from . import files

SUMMARY_SCHEMA = ", ".join(f"{c} string" for c in SUMMARY_COLUMNS)
ISOFORM_SCHEMA = ", ".join(f"{c} string" for c in ISOFORM_COLUMNS)
READ_COLUMNS = ("sequence_id", "umi", "umi_family", "umi_family_size", "umi_family_fraction", "umi_model_used", "umi_unique_count", "umi_unique_fraction", "umi_neighbor_risk", "splice_category", "size_class", "final_category", "alternative_d1_used", "unknown_sequence_after_d1")
FRACTIONS = ("umi_family_fraction", "umi_unique_fraction", "umi_neighbor_risk")
SUMMARY_NAME = re.compile(r"^output_strain_(.*)_distance_(.*)_assay_(.*)_summary\.csv$")
FEATURE_SCHEMA = "sample_name string, reference_strain string, distance string, assay string, file_path string"


def read_rows(df: DataFrame) -> DataFrame:
    """The 14 columns of the per-read table as text: None for what is missing, six decimals for fractions (halves to even)."""

    def shown(c: str) -> Column:
        text = F.format_string("%.6f", F.bround(F.col(c), 6)) if c in FRACTIONS else F.col(c).cast("string")
        return F.coalesce(F.when(F.col(c).isNotNull(), text), F.lit("None"))

    return df.select(*[shown(c).alias(c) for c in READ_COLUMNS])


def write_reads(df: DataFrame, path: str, single: bool = False) -> None:
    """Per-read TSV: a folder of parts, or one file."""
    _write(read_rows(df), path, single, sep="\t", emptyValue="")


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """Per-read table back with its types; None is missing."""
    rows = spark.read.csv(path, sep="\t", header=True, schema=", ".join(f"{c} string" for c in READ_COLUMNS))
    types = dict.fromkeys(FRACTIONS, "double") | {"umi_family_size": "bigint", "umi_unique_count": "bigint"}
    return rows.select(*[F.when(F.col(c) != "None", F.col(c)).cast(types.get(c, "string")).alias(c) for c in READ_COLUMNS])


def write_summary(df: DataFrame, path: str, single: bool = False) -> None:
    _write(df.select(*SUMMARY_COLUMNS), path, single, nullValue="NA", emptyValue="")


def read_summary(spark: SparkSession, *paths: str) -> DataFrame:
    return _na(spark.read.csv(list(paths), header=True, schema=SUMMARY_SCHEMA))


def read_isoforms(spark: SparkSession, path: str) -> DataFrame:
    return _na(spark.read.csv(path, header=True, schema=ISOFORM_SCHEMA))


def read_ratios(spark: SparkSession, path: str) -> dict[str, float]:
    """Shares of forms in mock data, a few dozen, in the file's order."""
    return {r.SpliceForm: r.ratio for r in spark.read.csv(path, header=True, schema="SpliceForm string, ratio double").collect()}


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=FEATURE_SCHEMA).orderBy("sample_name")


def _na(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(c).isin("", "NA"), F.col(c)).alias(c) for c in df.columns])


def _write(df: DataFrame, path: str, single: bool, **options: str) -> None:
    if not single:
        df.write.mode("overwrite").csv(path, header=True, **options)
        return
    # written by all tasks, in order, and put together under one header
    spark, parts = df.sparkSession, f"{path}.parts"
    df.write.mode("overwrite").csv(parts, header=False, **options)
    head = io.StringIO()
    csv.writer(head, delimiter=options.get("sep", ","), lineterminator="\n").writerow(df.columns)
    files.put_together(spark, head.getvalue(), [at for name, at, _ in files.listed(spark, parts) if name.startswith("part-")], path)
    files.delete(spark, parts)


def scan_runs(spark: SparkSession, folder: str) -> list[dict[str, str]]:
    """One run for each sub-folder: its first summary by name, with what the name says."""
    out = []
    for sample, sub, _ in (x for x in files.listed(spark, folder) if x[2]):
        for name, at, _ in (x for x in files.listed(spark, sub) if not x[2]):
            if m := SUMMARY_NAME.match(name):
                out.append({"sample_name": sample, "reference_strain": m[1], "distance": m[2], "assay": m[3], "file_path": at})
                break
    if not out:
        raise ValueError(f"no run summaries under {folder}")
    return out


def write_features(spark: SparkSession, runs: list[dict[str, str]], out: str) -> None:
    """run_features.csv, and the summaries copied beside it under their samples' names."""
    files.make_folder(spark, out)
    names = FEATURE_SCHEMA.replace(" string", "").split(", ")
    _write(spark.createDataFrame([tuple(r[n] for n in names) for r in runs], FEATURE_SCHEMA), f"{out}/run_features.csv", True)
    for r in runs:
        files.copy(spark, r["file_path"], f"{out}/{r['sample_name']}_summary.csv")


def read_samples(spark: SparkSession, out: str) -> DataFrame:
    """All *_summary.csv of a folder; ``id`` is the name's beginning."""
    rows = spark.read.csv(f"{out}/*_summary.csv", header=True, schema=SUMMARY_SCHEMA).select("*", F.regexp_extract("_metadata.file_name", r"^(.*)_summary\.csv$", 1).alias("id"))
    return rows.select("id", *[F.when(~F.col(c).isin("", "NA"), F.col(c)).alias(c) for c in SUMMARY_COLUMNS])


def write_params(spark: SparkSession, path: str, **params) -> None:
    files.write_text(spark, path, json.dumps(params, indent=2, default=str))


def csv_text(columns: list[str], rows: list) -> str:
    """A small table as CSV, empty where a value is missing."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([columns, *(["" if v is None else v for v in r] for r in rows)])
    return out.getvalue()


def embedded(text: str, kind: str = "text/csv") -> str:
    """A data URI of small text."""
    return f"data:{kind};base64,{base64.b64encode(text.encode()).decode()}"
