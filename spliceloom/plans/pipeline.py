"""The two analyses: one run from reads to summary and report frames, and the comparison of runs."""

from __future__ import annotations

import html
import json
import logging
import os
import sys
import time
from contextlib import contextmanager
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, build_config
from ..functions.lineage import cut, let_go
from ..functions.stats import SANE_MAXIMUM
from ..operators import annotate, association, chain, isoforms, report, summary, tally, umi
from ..operators.tally import Counted
from ..sources import files, tables
from ..sources import reads as read_source
from . import drawing as draw

VERSION = "0.1.0"
#: A p-value and how it was found.
PValue = tuple[float, str]
log = logging.getLogger("spliceloom")


@contextmanager
def timed(stage: str):
    """Seconds of a stage on stderr, if SPLICELOOM_TIMING is set."""
    began = time.perf_counter()
    yield
    if os.environ.get("SPLICELOOM_TIMING"):
        print(f"{stage}: {time.perf_counter() - began:.3f} s", file=sys.stderr)


def call_families(reads: DataFrame, config: RunConfig) -> DataFrame:
    """Per-read events with families; the events are stored once on the way."""
    splice = build_config(config.strain, config.assay, config.distance, config.genome)
    return _families(cut(chain.events(reads, splice, config.header)), config)


def _families(events: DataFrame, config: RunConfig) -> DataFrame:
    """The events are read twice: for the UMI counts, and for the rows."""
    return umi.families(events, config.family_model, config.distance, config.min_fraction, config.neighbor_risk, config.coverage_ratio)


def run_sets() -> dict[str, Counted]:
    """What a single run's report counts."""
    spliced, known = F.col("spliced") == "spliced", F.col("spliced") != "unknown"
    category = F.col("splice_category_2")
    one = lambda c, where=spliced: Counted({c: c}, where)
    return {
        "spliced_classes": one("spliced", None), "spliced_known": one("spliced", known), "size_classes": one("size_class"), "d1_types": one("D1_type"), "d1_types_detailed": one("D1_type_revised"),
        "main_acceptors": one("main_acceptor_after_d1"), "isoforms": one("splice_cat2"), "isoforms_extended": one("splice_category_2"),
        "isoforms_by_d1": Counted({"splice_cat2": "splice_cat2", "D1_type_revised": "D1_type_revised"}, spliced),
        "isoforms_by_size": Counted({"splice_cat2": "splice_cat2", "size_class": "size_class"}, spliced),
        "acceptors_by_d1": Counted({"D1_type_revised": "D1_type_revised", "main_acceptor_after_d1": "main_acceptor_after_d1"}, spliced),
        "cascade": Counted({"splice_cat2": "splice_cat2"} | {c: c for c in report.STEPS}, ~F.col("splice_cat2").isin("Incomplete", "Unspliced")),
        "flow": Counted({"final_des": "final_des", "splice_cat2": "splice_cat2"}, spliced & (F.col("D1_type_revised") != "Others") & (F.col("final_des") != "Incomplete")),
        "after_a1": Counted({"A1_fate": annotate.a1_fate(category)}, annotate.reaches_a1()),
        "after_a2": Counted({"upstream_event": annotate.upstream_event(), "A2_fate": annotate.a2_fate(category)}, annotate.reaches_a2()),
    }


def report_frames(annotated: DataFrame) -> tuple[dict[str, DataFrame], dict[str, PValue | None]]:
    """Everything a single run's report shows, from one pass over the rows, and the p-values of its cross tables."""
    sets = run_sets()
    tallied = tally.tally(annotated, sets)
    n = lambda name: tally.frame(tallied, sets, name)
    frames = {}
    for name, s in sets.items():
        by = list(s.columns)
        if name == "isoforms_by_d1":
            frames[name] = report.pivot_of(n(name), *by, list(annotate.D1_LEVELS))
        elif name == "isoforms_by_size":
            frames[name] = report.pivot_of(n(name), *by, ["1.8kb", "4kb", "Both", "Unknown"])
        elif name == "cascade":
            frames["links"] = report.links_of(n("isoforms_extended"))
            frames[name] = report.cascade_of(n(name))
        else:
            rows = n(name).where(F.col(by[1]).isNotNull()) if name in ("acceptors_by_d1", "after_a2") else n(name)
            frames[name] = report.shares(rows, by, by[:1] if len(by) > 1 else None)
    frames |= {"sankey": report.sankey(frames["cascade"]), "map": report.splice_map(frames["links"])}
    return frames, p_values(tallied, ["isoforms_by_d1", "isoforms_by_size", "acceptors_by_d1", "after_a2"])


def p_values(tallied: DataFrame, tests: list[str]) -> dict[str, PValue | None]:
    """P-value and method by test, None for a table of one row or column."""
    found = association.tested(association.cells(tallied.where(F.col("frame").isin(*tests)))).collect()
    return dict.fromkeys(tests) | {r.test: (r.p_value, r.method) for r in found if r.method}


def comparison_sets() -> dict[str, Counted]:
    """What a comparison counts, by sample."""
    spliced, known = F.col("spliced") == "spliced", F.col("spliced") != "unknown"
    by_id = lambda name, where=spliced, c=None: Counted({"id": "id", name: c if c is not None else name}, where)
    return {
        "rows": Counted({"id": "id"}), "spliced_classes": by_id("spliced", None), "percent_spliced": by_id("spliced", known), "size_classes": by_id("size_class"),
        "d1_types": by_id("D1_type_revised2", c=annotate.d1_type_revised2(F.col("D1_type"))), "d1_types_detailed": by_id("D1_type_revised"), "main_acceptors": by_id("main_acceptor_after_d1"),
        "isoforms": by_id("splice_cat2"), "final_destinations": by_id("final_des"), "after_a1": by_id("A1_fate", annotate.reaches_a1(), annotate.a1_fate(F.col("splice_category_2"))),
        "after_a2": by_id("A2_fate", annotate.reaches_a2(), annotate.a2_fate(F.col("splice_category_2"))),
    }


def comparison_frames(pooled: DataFrame) -> tuple[dict[str, DataFrame], dict[str, PValue | None]]:
    """Everything a comparison of samples shows, from one pass over the rows, every share within the sample; and the p-values by sample."""
    sets = comparison_sets()
    tallied = tally.tally(pooled, sets)
    frames = {name: tally.frame(tallied, sets, name) if name == "rows" else report.shares(tally.frame(tallied, sets, name), list(s.columns), ["id"]) for name, s in sets.items()}
    frames["percent_spliced"] = frames["percent_spliced"].where(F.col("spliced") == "spliced")
    return frames, p_values(tallied, [x for x in sets if x not in ("rows", "spliced_classes")])


#: How a frame is drawn: label columns and the value of its bars.
BARS = {
    "spliced_classes": (["spliced"], "percent"), "size_classes": (["size_class"], "percent"), "d1_types": (["D1_type"], "percent"), "d1_types_detailed": (["D1_type_revised"], "percent"),
    "main_acceptors": (["main_acceptor_after_d1"], "percent"), "isoforms": (["splice_cat2"], "percent"), "after_a1": (["A1_fate"], "percent"), "after_a2": (["upstream_event", "A2_fate"], "percent"),
    "acceptors_by_d1": (["D1_type_revised", "main_acceptor_after_d1"], "percent"), "flow": (["final_des", "splice_cat2"], "percent"), "umi_histogram": (["reads"], "umis"),
}
COMPARED = {
    "percent_spliced": (["id"], "percent"), "size_classes": (["id", "size_class"], "percent"), "d1_types": (["id", "D1_type_revised2"], "percent"), "d1_types_detailed": (["id", "D1_type_revised"], "percent"),
    "main_acceptors": (["id", "main_acceptor_after_d1"], "percent"), "final_destinations": (["id", "final_des"], "percent"), "after_a1": (["id", "A1_fate"], "percent"), "after_a2": (["id", "A2_fate"], "percent"),
}
TITLES = {"D1_type": "D1 type", "D1_type_revised": "D1 type in detail", "D1_type_revised2": "D1 type", "splice_cat2": "isoform", "splice_category_2": "splice category", "main_acceptor_after_d1": "acceptor after D1", "final_des": "final destination", "A1_fate": "after A1", "A2_fate": "after A2", "upstream_event": "way to A2", "n": "families", "w": "families", "percent": "%", "id": "sample", "size_class": "size class"}


def ordered(df: DataFrame) -> DataFrame:
    """Samples together, the largest numbers first, equal ones by what they are of."""
    first = [c for c in ("id",) if c in df.columns]
    number = next((c for c in ("n", "w", "splice_category_count", "umis") if c in df.columns), None)
    rest = [c for c in df.columns if c not in (*first, number)]
    return df.orderBy(*first, *([F.desc(number)] if number else []), *[F.col(f"`{c}`") for c in rest])


def drawing(name: str, rows: list, columns: list[str], shapes: dict) -> str:
    if name in shapes and rows:
        return draw.bars(rows, *shapes[name])
    if name == "sankey" and rows:
        return draw.sankey(rows)
    return ""


def page(title: str, frames: dict[str, DataFrame], folder: str, shapes: dict, tests: dict[str, PValue | None] | None = None, most_rows: int = 1000) -> str:
    """An HTML page of the frames, sorted and drawn, with p-values of association.

    They are counts by category.  Of a longer frame the page shows the first rows,
    and links to a CSV file beside it that holds all.
    """
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in frames.items():
        sorted_ = ordered(df)
        rows = sorted_.limit(most_rows + 1).collect()
        shown = rows[:most_rows]
        cells = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else f'{v:.4g}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in shown)
        head = "".join(f"<th>{html.escape(TITLES.get(c, c))}</th>" for c in df.columns)
        if len(rows) > most_rows:
            tables._write(sorted_, f"{folder}/{name}.csv", True)
            link, note = f"{name}.csv", f"<p>The first {most_rows} rows; the file has all.</p>"
        else:
            link, note = tables.embedded(tables.csv_text(df.columns, rows)), ""
        if tests and name in tests:
            note += "<p>Association: " + ("not tested, one row or column" if tests[name] is None else f"p = {tests[name][0]:.3g} ({tests[name][1]})") + "</p>"
        picture = draw.splice_map(shown, frames["features"].collect(), report.GENOME_END) if name == "map" and rows else drawing(name, shown, df.columns, shapes)
        parts.append(f"<h2>{html.escape(name.replace('_', ' '))}</h2>{note}{picture}<table><tr>{head}</tr>{cells}</table><a download='{name}.csv' href='{link}'>CSV</a>")
        if name == "links":
            # a category's text cannot close the script
            data = json.dumps([r.asDict() for r in rows]).replace("</", "<\\/")
            parts.append(f"<script>window.links = {data};</script>")
    return "\n".join(parts)


def run(spark: SparkSession, config: RunConfig, partitions: int | None = None, single: bool = False) -> dict[str, str]:
    """Reads to per-read table (a folder of parts, or one file if ``single``), summary, parameters and report; the paths written."""
    out = config.out.rstrip("/")
    with timed("folder"):
        files.make_folder(spark, out)
        paths = {"reads": f"{out}/{config.stem}.tsv", "summary": f"{out}/{config.stem}_summary.csv", "params": f"{out}/params.json", "report": f"{out}/{config.stem}.html", "isoforms": f"{out}/isoforms.csv"}
    with timed("search patterns"):
        splice = build_config(config.strain, config.assay, config.distance, config.genome)
    with timed("read pairs"):
        reads = read_source.read_pairs(spark, config.r1, config.r2, partitions or spark.sparkContext.defaultParallelism)
        seen = Observation("reads")
        reads = reads.observe(seen, *chain.reject_counts(config.header, config.distance))
    with timed("events"):
        events = cut(chain.events(reads, splice, config.header))
    left_out = {k: v for k, v in seen.get.items()}
    with timed("families"):
        rows = cut(_families(events, config))  # for the three tables below
        let_go(events)
    with timed("per-read table"):
        tables.write_reads(rows, paths["reads"], single)
    umis = umi.counts(rows)
    most = umis.agg(F.max("n")).first()[0]
    if most and most > SANE_MAXIMUM:
        log.warning("a UMI has %d reads: the cut-off is not meaningful beyond %d", most, SANE_MAXIMUM)
    with timed("summary"):
        tables.write_summary(summary.summarize(rows), paths["summary"], single=True)
    with timed("isoform lookup"):
        lookup = known_isoforms(spark, config.isoforms)
        tables._write(isoforms.lookup(spark) if lookup is None else lookup, paths["isoforms"], True)
    with timed("report"):
        annotated = annotate.annotate(tables.read_summary(spark, paths["summary"]), lookup).cache()
        frames, tests = report_frames(annotated)
        frames |= {"umi_histogram": umi.histogram(umis), "features": report.genome_features(spark)}
        files.write_text(spark, paths["report"], page(config.stem, frames, out, BARS, tests))
        annotated.unpersist()
    let_go(rows)
    settings = {k: v for k, v in asdict(config).items() if k != "genome"}
    tables.write_params(spark, paths["params"], version=VERSION, summary=paths["summary"], reads=left_out, **settings)
    return paths


def known_isoforms(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A lookup of the user's own, in which every form has one row; None for the built-in one."""
    if path is None:
        return None
    lookup = tables.read_isoforms(spark, path)
    if twice := lookup.groupBy("SpliceForm").count().where("count > 1").select("SpliceForm").first():
        raise ValueError(f"the isoform lookup has {twice[0]} more than once")
    return lookup


def compare(spark: SparkSession, folder: str, out: str, lookup: str | None = None) -> dict[str, str]:
    """Summaries of all runs under a folder to a pooled table and a comparison page."""
    out = out.rstrip("/")
    runs = tables.scan_runs(spark, folder)
    if len({r["assay"] for r in runs}) > 1:
        log.warning("the runs are of different assays: %s", sorted({r["assay"] for r in runs}))
    tables.write_features(spark, runs, out)
    pooled = annotate.annotate(tables.read_samples(spark, out), known_isoforms(spark, lookup)).cache()
    tables._write(pooled, f"{out}/pooled_annotated_data.csv", True, nullValue="NA")
    shown, tests = comparison_frames(pooled)
    frames = {"runs": tables.read_features(spark, f"{out}/run_features.csv")} | shown
    files.write_text(spark, f"{out}/comparison.html", page("Comparison of samples", frames, out, COMPARED, tests))
    pooled.unpersist()
    return {"pooled": f"{out}/pooled_annotated_data.csv", "report": f"{out}/comparison.html"}
