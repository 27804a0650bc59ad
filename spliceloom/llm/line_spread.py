"""Line dedup by distinct-site spread.

Per hash of a trimmed line, a HyperLogLog sketch of the sites it occurs on is
built and merged by aggregation: each map task sends one sketch per line and not
its occurrences, so a line on a third of all rows costs no more than another.
Lines whose estimate is near the threshold get an exact distinct count.  A line
that spreads over ``min_sites`` or more sites is boilerplate: it stays in the
document with the smallest id that has it and is removed from all others.

Defined results: null text has no lines and stays null; blank lines are neither
counted nor removed; a null site counts as one site of its own; lines are the
parts between newlines, compared without leading and trailing blanks (ties are
equal hashes); a document of which nothing stays has empty text; long texts and
lines are taken whole; repeated rows of one id count as one document and each
return; a null id sorts after all others; an empty table is empty; other columns
may have any name and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, if_small, named, text_hash

MIN_SITES = 5
#: log2 of the registers: standard error about 1.04 / sqrt(2**12) = 1.6 %.
LG_K = 12
#: Estimates within this share of the threshold are counted exactly (over six standard errors), one site at least.
MARGIN = 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """h (hash of a line that is not blank), site, id, th (hash of the text), pos: one row per line."""
    split = docs.select(named(key).alias("id"), text_hash(text).alias("th"), F.coalesce(named(site).cast("string"), F.lit("\u0000")).alias("site"), F.posexplode(_lines(named(text))).alias("pos", "line"))
    return split.where(F.trim("line") != "").select(F.xxhash64(F.trim("line")).alias("h"), "site", "id", "th", "pos")


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source", margin: float = MARGIN) -> DataFrame:
    """h and home (the smallest id) of the lines on ``min_sites`` or more sites."""
    rows = line_rows(docs, key, text, site)
    spread = rows.groupBy("h").agg(F.hll_sketch_agg("site", LG_K).alias("s"), F.min("id").alias("home"))
    guess = cut(spread.select("h", "home", F.hll_sketch_estimate("s").alias("sites")).where(F.col("sites") >= min(min_sites * (1 - margin), min_sites - 1)))
    near = F.col("sites") <= max(min_sites * (1 + margin), min_sites + 1)
    sure = guess.where(~near).select("h", "home")
    band = guess.where(near).select("h", "home")
    # exact counts: the lines of the band alone, each site once per map task
    exact = rows.select("h", "site").join(if_small(band.select("h")), "h", "left_semi").groupBy("h").agg(F.countDistinct("site").alias("n")).where(F.col("n") >= min_sites)
    return sure.unionByName(band.join(exact, "h", "left_semi"))


def spread(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """row (struct of the table's columns, the text cleaned), n_lines (not blank) and n_removed: one row per input row."""
    found = cut(boilerplate(docs, min_sites, key, text, site))
    gone = line_rows(docs, key, text, site).select("h", "id", "th", "pos").join(if_small(found), "h").where(~F.col("id").eqNullSafe(F.col("home")))
    # places of a text's own removed lines: no more than it has lines
    per_text = gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone")).toDF("to_id", "to_th", "gone")
    every = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), named(key).alias("id"), text_hash(text).alias("th"), named(text).alias("text"))
    joined = every.join(per_text, every["id"].eqNullSafe(per_text["to_id"]) & (every["th"] == per_text["to_th"]), "left")
    places = F.col("gone")

    def kept(lines: Column) -> Column:
        """What lies between the removed places, one slice after another: linear in the lines."""
        before = lambda k: F.when(k == 0, -1).otherwise(F.get(places, k - 1))
        after = lambda k: F.when(k == F.size(places), F.size(lines)).otherwise(F.get(places, k))
        parts = F.transform(F.sequence(F.lit(0), F.size(places)), lambda k: F.slice(lines, before(k) + 2, after(k) - before(k) - 1))
        return F.array_join(F.flatten(parts), "\n")

    # the array of one binds the lines, so that a text is split once
    clean = F.when(places.isNull(), F.col("text")).otherwise(F.get(F.transform(F.array(_lines(F.col("text"))), kept), F.lit(0)))
    row = F.struct(*[clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
    n = F.size(F.filter(_lines(F.coalesce("text", F.lit(""))), lambda x: F.trim(x) != ""))
    return joined.select(row.alias("row"), n.cast("bigint").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, all rows and columns kept."""
    return spread(docs, min_sites, key, text, site).select("row.*")


#: What DuckDB makes of ``op3`` over documents; SITES stands for min_sites.
SQL = """
WITH l AS (
  SELECT doc_id, coalesce(source, chr(1)) AS site, pos, line, trim(line, ' ') AS t
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents)
), b AS (
  SELECT t, min(doc_id) AS home FROM l WHERE t <> '' GROUP BY t HAVING count(DISTINCT site) >= SITES
), k AS (
  SELECT l.doc_id, l.pos, l.line, l.t, b.t IS NOT NULL AND l.doc_id <> b.home AS gone FROM l LEFT JOIN b ON l.t = b.t
), a AS (
  SELECT doc_id, count(*) FILTER (t <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM k GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id
"""
