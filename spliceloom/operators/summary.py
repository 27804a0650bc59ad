"""One row per UMI family and category: common alternative donor, class, D1 type, distinct rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNSPLICED = ("D1_D1-unspliced", "D1_gag-AUG", "noD1_gag-AUG_unspliced")
COLUMNS = ("umi_family", "splice_category", "size_class", "final_category", "alternative_d1_used_common", "spliced", "D1_type", "splice_category_2")


def spliced_class(category: Column) -> Column:
    return F.when(category.contains("D1_unknown") | category.contains("no-acceptor"), "unknown").when(category.isin(*UNSPLICED), "unspliced").otherwise("spliced")


def d1_type(spliced: Column, category: Column) -> Column:
    return F.when(spliced == "spliced", F.when(category.contains("noD1_"), "Alternative D1").when(category.contains("D1prime_"), "D1prime").otherwise("D1"))


def splice_category_2(spliced: Column, category: Column) -> Column:
    """The category with any D1 type named D1, for spliced reads; else the class."""
    return F.when(spliced == "spliced", F.regexp_replace(F.regexp_replace(category, "D1prime", "D1"), "noD1", "D1")).otherwise(spliced)


def first_seen_mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """``keys`` and the most frequent value of each group; of equal ones the first seen by ``order``.

    Counted before the choice: a group is one row per distinct value by then.
    """
    return most_frequent(df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("at")), keys, value)


def most_frequent(counted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The same from counts: ``keys``, value, n and at (the first place it was seen)."""
    return counted.groupBy(*keys).agg(F.max_by(F.struct(value), F.struct("n", -F.col("at")))[value].alias(f"{value}_common"))


def summarize(families: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct family rows of reads with families (read_ix orders them); ``by``: columns of samples to keep apart.

    In the text form that this step reads, a missing donor is the word None and an
    empty one is missing.
    """
    kept = families.where("umi_family is not null").withColumn("alternative_d1_used", F.when(F.col("alternative_d1_used").isNull(), "None").when(F.col("alternative_d1_used") == "", None).otherwise(F.col("alternative_d1_used")))
    keys = [*by, "umi_family", "splice_category"]
    # one pass over the reads: what follows works on their distinct combinations
    each = kept.groupBy(*keys, "size_class", "final_category", "alternative_d1_used").agg(F.count("*").alias("n"), F.min("read_ix").alias("at"))
    common = most_frequent(each.groupBy(*keys, "alternative_d1_used").agg(F.sum("n").alias("n"), F.min("at").alias("at")), keys, "alternative_d1_used")
    rows = each.select(*keys, "size_class", "final_category").distinct().join(common, keys)
    spliced = spliced_class(F.col("splice_category"))
    rows = rows.withColumn("spliced", spliced)
    rows = rows.withColumn("D1_type", d1_type(F.col("spliced"), F.col("splice_category"))).withColumn("splice_category_2", splice_category_2(F.col("spliced"), F.col("splice_category")))
    return rows.select(*by, *COLUMNS)
