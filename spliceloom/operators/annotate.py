"""Annotation of family summaries: main acceptor, detailed D1 types, isoform lookup, fates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import isoforms

# ---- fixed values: bases before the acceptor by which alternative D1 sites are told apart, and their names
GC_NEAR, GC_FAR = "GCTGAAGCGCGCACG", "CGCGCACGGCAAGAG"
D1_PRIMER = ("GCGCGCACGGCAAGA", "CGGCAAGAGGCGAGA", "CAGGACTCGGCTTGA")
GT_GAG, GT_GAG_DOWN = "GAAGGAGAGAGATGG", "GGTGCGAGAGCGTCG"
D1_LEVELS = ("GC 3 base downstream of DIS", "GC 10 base downstream of DIS", "D1", "D1prime", "GU downstream gag AUG", "GU further downstream in gag", "Others")
FINAL_LEVELS = ("A3", "A4", "A5", "A7", "vif", "vpr", "Incomplete")
MAIN_ACCEPTORS = ("A1", "A2", "A3", "A4", "A5", "A7")
A1_LEVELS = ("Spliced at D2/D2b", "No splicing after A1/vif", "Incomplete", "Sequence after D2/D2b unrecognized")
A2_LEVELS = ("Spliced at D3", "No splicing after A2/vpr", "Incomplete", "Sequence after D3 too short/unrecognized")
# ---- end of fixed values


def main_acceptor(category2: Column, spliced: Column) -> Column:
    c = F.when(spliced == "unspliced", "unspliced")
    for a in MAIN_ACCEPTORS:
        c = c.when(category2.contains(f"D1_{a}"), a)
    return F.when(spliced.isNotNull(), c)


def d1_type_revised(spliced: Column, d1: Column, common: Column) -> Column:
    """Detailed D1 type of spliced rows; NULL where an alternative D1 left no bases to tell it by."""
    among = lambda *x: F.coalesce(common.isin(*x), F.lit(False))
    near, far, own, own2, gag, down, others = D1_LEVELS
    return F.when(
        spliced == "spliced",
        F.when(among(GC_NEAR), near)
        .when(among(GC_FAR), far)
        .when((d1 == "D1prime") | among(*D1_PRIMER), own2)
        .when(among(GT_GAG), gag)
        .when(among(GT_GAG_DOWN), down)
        .when(common != "None", others)
        .otherwise(F.when(d1 != "Alternative D1", d1)),
    )


def d1_type_rewritten(revised: Column, d1: Column) -> Column:
    return F.when(revised == "D1prime", "D1prime").when(revised.isNotNull(), d1)


def within(value: Column, levels: tuple[str, ...]) -> Column:
    """The value if it is one of the levels, else NULL."""
    return F.when(value.isin(*levels), value)


def annotate(summary: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Summary rows with annotations; the built-in lookup of a few dozen rows is broadcast, another one if Spark finds it small."""
    known = lookup if lookup is not None else F.broadcast(isoforms.lookup(summary.sparkSession))
    known = known.withColumnRenamed("size_class", "size_class_known")
    rows = summary.withColumn("main_acceptor_after_d1", main_acceptor(F.col("splice_category_2"), F.col("spliced")))
    rows = rows.withColumn("D1_type_revised", d1_type_revised(F.col("spliced"), F.col("D1_type"), F.col("alternative_d1_used_common")))
    rows = rows.withColumn("D1_type", d1_type_rewritten(F.col("D1_type_revised"), F.col("D1_type")))
    rows = rows.join(known, rows.splice_category_2 == known.SpliceForm, "left").drop("SpliceForm")
    return rows.withColumn("final_des", within(F.col("final_des"), FINAL_LEVELS)).withColumn("D1_type_revised", within(F.col("D1_type_revised"), D1_LEVELS))


def a1_fate(c: Column) -> Column:
    spliced, none, incomplete, lost = A1_LEVELS
    return F.when(c.contains("D2_unknown"), lost).when(c.contains("noD2b"), incomplete).when(c.contains("D2b_unknown"), lost).when(c.contains("noD2"), incomplete).when(c.contains("D2b-unspliced"), none).otherwise(spliced)


def a2_fate(c: Column) -> Column:
    spliced, none, incomplete, lost = A2_LEVELS
    return F.when(c.contains("noD3"), incomplete).when(c.contains("D3_unknown"), lost).when(c.contains("D3-unspliced"), none).otherwise(spliced)


def reaches_a1() -> Column:
    return (F.col("spliced") == "spliced") & (F.col("main_acceptor_after_d1") == "A1")


def reaches_a2() -> Column:
    return (F.col("spliced") == "spliced") & F.col("splice_category_2").rlike("D2_A2|D2b_A2|D1_A2")


def upstream_event() -> Column:
    return F.when(F.col("main_acceptor_after_d1") == "A1", "D1->A1->A2").when(F.col("main_acceptor_after_d1").isNotNull(), "D1->A2")


def reaching_a1(annotated: DataFrame) -> DataFrame:
    return annotated.where(reaches_a1()).withColumn("A1_fate", a1_fate(F.col("splice_category_2")))


def reaching_a2(annotated: DataFrame) -> DataFrame:
    return annotated.where(reaches_a2()).withColumn("A2_fate", a2_fate(F.col("splice_category_2"))).withColumn("upstream_event", upstream_event())


def d1_type_revised2(d1: Column) -> Column:
    """Alternative D1 against D1 and D1prime together."""
    return F.when(d1 == "Alternative D1", d1).when(d1.isNotNull(), "D1/D1prime")
