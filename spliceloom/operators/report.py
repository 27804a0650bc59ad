"""Frames of the reports: counts, shares, splice links, cascades, cross-tables, comparisons of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ---- fixed values: sites on the genome map, and its features (row, name, start, end), in HXB2 coordinates
GENOME_END = 9719
ANCHORS = {"D1": 743, "A1": 4913, "D2": 4962, "A2": 5390, "D3": 5463, "A3": 5777, "A4": 5955, "A5": 5977, "D4": 6045, "A7": 8379}
FEATURES = (
    (1, "5'-LTR", 1, 634), (1, "gag", 790, 2292), (1, "vif", 5041, 5619), (1, "tat-2", 8379, 8424), (1, "nef", 8797, 9417),
    (2, "tat-1", 5831, 6045), (2, "vpu", 6062, 6310), (2, "rev-2", 8379, 8653), (2, "3'-LTR", 9407, GENOME_END),
    (3, "pol", 2085, 5096), (3, "pro", 2253, 2550), (3, "vpr", 5559, 5850), (3, "rev-1", 5970, 6045), (3, "env", 6225, 8795),
)
# ---- end of fixed values
STEPS = ("step1", "step2", "step3", "step4", "step5", "step6", "step7", "step8")


def counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows of each combination, and nothing sorted: sort for display."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def percent(df: DataFrame, by: list[str], within: list[str] | None = None) -> DataFrame:
    """Counts with their percentage of all rows, or of the rows equal in ``within``."""
    return shares(counts(df, *by), by, within)


def shares(n: DataFrame, by: list[str], within: list[str] | None = None) -> DataFrame:
    """Counts with their percentages; the window runs over the counts, one row per combination."""
    if within:
        total = F.sum("n").over(Window.partitionBy(*within))
        return n.withColumn("percent", 100.0 * F.col("n") / total)
    total = n.agg(F.sum("n").alias("__total"))
    return n.join(F.broadcast(total), F.lit(True)).select(*by, "n", (100.0 * F.col("n") / F.col("__total")).alias("percent"))


def spliced_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("spliced") == "spliced")


def known_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("spliced") != "unknown")


def percent_spliced(df: DataFrame) -> DataFrame:
    """Share of spliced rows among spliced and unspliced ones of each sample."""
    return percent(known_only(df), ["id", "spliced"], ["id"]).where(F.col("spliced") == "spliced")


def edges(category2: Column) -> Column:
    """Links of one spliced category as structs of from and to: D1's, then D2's and D3's where they have an acceptor."""
    link = lambda a, to: F.struct(F.lit(a).alias("from"), to.alias("to"))
    d2, d3 = F.regexp_extract(category2, "D2b?_(A[0-9]+)", 1), F.regexp_extract(category2, "D3_(A[0-9]+)", 1)
    return F.filter(F.array(link("D1", F.substring(category2, 4, 2)), F.when(d2 != "", link("D2", d2)), F.when(d3 != "", link("D3", d3))), lambda x: x.isNotNull())


def links(annotated: DataFrame) -> DataFrame:
    """from, to, w, percent of all spliced rows: from the counts of categories."""
    return links_of(counts(spliced_only(annotated), "splice_category_2"))


def links_of(n: DataFrame) -> DataFrame:
    total = n.agg(F.sum("n").alias("total"))
    e = n.select(F.explode(edges(F.col("splice_category_2"))).alias("e"), "n").groupBy("e.from", "e.to").agg(F.sum("n").alias("w"))
    exact = F.col("w") * 100.0 / F.col("total")
    return e.join(F.broadcast(total), F.lit(True)).select("from", "to", "w", exact.alias("percent_exact"), F.round(exact, 1).alias("percent"))


def splice_map(link_frame: DataFrame) -> DataFrame:
    """Links with their ends' places on the genome; links to other sites have none and are left out."""
    spark = link_frame.sparkSession
    sites = spark.createDataFrame(list(ANCHORS.items()), "site string, pos int")
    a, b = sites.withColumnsRenamed({"site": "from", "pos": "from_pos"}), sites.withColumnsRenamed({"site": "to", "pos": "to_pos"})
    return link_frame.join(F.broadcast(a), "from").join(F.broadcast(b), "to").withColumn("width", F.sqrt("percent_exact"))


def genome_features(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*FEATURES], "row int, name string, start int, end int")


def pivot(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts with one column for each value and one for rows without (named NA); 0 where there is none."""
    return pivot_of(counts(df, row, column), row, column, values)


def pivot_of(n: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    tagged = n.withColumn("__c", F.coalesce(F.col(column), F.lit("NA")))
    return tagged.groupBy(row).pivot("__c", [*values, "NA"]).agg(F.sum("n")).na.fill(0)


def cross_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """Counts of each value by group with percentages within the group; rows without the value are not counted."""
    return percent(df.where(F.col(value).isNotNull()), [group, value], [group])


def cascade(annotated: DataFrame) -> DataFrame:
    """splice_cat2, its count, Steps and value: the steps of each isoform, one a row."""
    return cascade_of(counts(annotated.where(~F.col("splice_cat2").isin("Incomplete", "Unspliced")), "splice_cat2", *STEPS))


def cascade_of(n: DataFrame) -> DataFrame:
    wide = n.withColumn("splice_category_count", F.sum("n").over(Window.partitionBy("splice_cat2")))
    return wide.unpivot(["splice_cat2", "splice_category_count"], list(STEPS), "Steps", "value").select("splice_cat2", "splice_category_count", "Steps", "value")


def sankey(cascade_frame: DataFrame) -> DataFrame:
    """Consecutive steps of each isoform as source and target, with its count."""
    after = F.lead("value").over(Window.partitionBy("splice_cat2").orderBy("Steps", "value"))
    rows = cascade_frame.where("value is not null").withColumn("target", after).where("target is not null")
    return rows.select("splice_cat2", F.col("value").alias("source"), "target", F.col("splice_category_count").alias("value"))


def flow(annotated: DataFrame) -> DataFrame:
    """Isoforms by final destination, without the unclassified D1 types; with shares of the destination."""
    rows = spliced_only(annotated).where(F.col("D1_type_revised") != "Others").where(F.col("final_des").isNotNull() & (F.col("final_des") != "Incomplete"))
    return percent(rows, ["final_des", "splice_cat2"], ["final_des"])


def union_samples(samples: dict[str, DataFrame]) -> DataFrame:
    """Summaries of several samples, each row with its sample as ``id``."""
    out = None
    for name, df in samples.items():
        tagged = df.withColumn("id", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no samples")
    return out
