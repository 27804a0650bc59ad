"""UMI families: the frequency model, abundance-ordered clustering, and automatic choice between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FamilyModel
from ..functions import stats
from ..functions.lineage import cut, let_go
from ..functions.seq import chunk_bounds
from . import neighbours

CATEGORY = "final_category"
#: Distinct UMIs of a category that one task clusters; larger categories are clustered by joins.
TASK_UMIS = 20_000
#: Rows of families and decisions that are sent to every task, at most; more are joined by a shuffle.
SENT_ROWS = 200_000


def counts(events: DataFrame) -> DataFrame:
    """final_category, umi, n: reads of each exact UMI."""
    return events.groupBy(CATEGORY, "umi").agg(F.count("*").alias("n"))


def max_model(umis: DataFrame) -> DataFrame:
    """UMIs with more reads than the cut-off that the category's most frequent one gives; each is its own family."""
    top = umis.groupBy(CATEGORY).agg(F.max("n").alias("most"))
    return umis.join(top, CATEGORY).where(F.col("n") > stats.cutoff(F.col("most"))).select(CATEGORY, "umi", F.col("umi").alias("umi_family"))


def decisions(umis: DataFrame, model: str, distance: int, risk_limit: float = 0.05, coverage: float = 0.10) -> DataFrame:
    """One row per category: model used, distinct UMIs, their share of reads, and the neighbour risk (automatic choice only)."""
    model = FamilyModel(model)
    by_length = umis.groupBy(CATEGORY, F.length("umi").alias("len")).agg(F.count("*").alias("u"), F.sum("n").alias("reads"), F.bool_and(F.col("umi").rlike("^[ACGT]*$")).alias("plain"))
    risk = stats.neighbour_risk(F.col("u"), F.col("len"), distance)
    all_ = by_length.groupBy(CATEGORY).agg(F.sum("u").alias("umi_unique_count"), F.sum("reads").alias("reads"), F.bool_and("plain").alias("plain"), F.max(risk).alias("risk"))
    share = F.col("umi_unique_count") / F.col("reads")
    if model is not FamilyModel.AUTO:
        used, shown = F.lit(model.value), F.lit(None).cast("double")
    else:
        shown = F.when(F.col("plain"), F.col("risk"))
        used = F.when((share <= coverage) | shown.isNull() | (shown >= risk_limit), FamilyModel.MAX.value).otherwise(FamilyModel.CLUSTER.value)
    return all_.select(CATEGORY, used.alias("umi_model_used"), "umi_unique_count", share.alias("umi_unique_fraction"), shown.alias("umi_neighbor_risk"))


def hamming_pairs(umis: DataFrame, distance: int, by: tuple[str, ...] = (CATEGORY,)) -> DataFrame:
    """Pairs (a, b), a < b, of distinct UMIs of a category and length within ``distance`` substitutions; ``umis`` is read three times."""
    return neighbours.pairs(umis, distance, by)


def cluster(umis: DataFrame, distance: int, min_fraction: float, task_umis: int = TASK_UMIS) -> DataFrame:
    """final_category, umi, umi_family: greedy clusters around the most frequent UMIs.

    UMIs are taken by falling count, then by name; each becomes a parent unless an
    earlier parent within ``distance`` has claimed it.  No chaining: only parents
    claim.  Families under ``min_fraction`` of the category's reads are dropped.
    """
    umis = cut(umis)  # the steps and rounds below read it many times: counted from the reads once
    size = umis.groupBy(CATEGORY).agg(F.count("*").alias("u"))
    tagged = umis.join(size, CATEGORY)
    small, big = tagged.where(F.col("u") <= task_umis).drop("u"), tagged.where(F.col("u") > task_umis).drop("u")
    schema = f"{CATEGORY} string, umi string, n bigint, umi_family string"
    found = cut(small.groupBy(CATEGORY).applyInPandas(lambda pdf: _greedy(pdf, distance), schema))  # clustered once, used three times below
    if not size.where(F.col("u") > task_umis).isEmpty():
        found = found.unionByName(_by_joins(big, distance))
    return _large_enough(found, min_fraction)


def _large_enough(found: DataFrame, min_fraction: float) -> DataFrame:
    family = found.groupBy(CATEGORY, "umi_family").agg(F.sum("n").alias("size"))
    least = found.groupBy(CATEGORY).agg(F.ceil(F.sum("n") * F.lit(float(min_fraction))).alias("least"))
    keep = family.join(least, CATEGORY).where("size >= least").select(CATEGORY, "umi_family")
    return found.join(keep, [CATEGORY, "umi_family"]).select(CATEGORY, "umi", "umi_family")


def _greedy(pdf: pd.DataFrame, distance: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["n", "umi"], ascending=[False, True], kind="stable").reset_index(drop=True)
    umis = pdf["umi"].tolist()
    family: list[str | None] = [None] * len(umis)
    files: dict[tuple, list[int]] = {}
    keys = [list(_keys(u, distance)) for u in umis]
    for i, ks in enumerate(keys):
        for k in ks:
            files.setdefault(k, []).append(i)
    for i, parent in enumerate(umis):
        if family[i] is not None:
            continue
        family[i] = parent
        for k in keys[i]:
            for j in files[k]:
                if family[j] is None and sum(x != y for x, y in zip(parent, umis[j])) <= distance:
                    family[j] = parent
    pdf["umi_family"] = family
    return pdf


def _keys(umi: str, distance: int) -> Iterator[tuple]:
    if distance >= len(umi):
        yield (len(umi),)
    else:
        for i, (a, b) in enumerate(chunk_bounds(len(umi), distance + 1)):
            yield (len(umi), i, umi[a:b])


def _by_joins(umis: DataFrame, distance: int) -> DataFrame:
    """The same assignment for categories of any size.

    Rounds decide nodes: one whose earlier neighbours are all known not to be
    parents is a parent; one with an earlier parent before which no neighbour is
    undecided belongs to it.  The earliest undecided node is always decided, so
    the rounds end.
    """
    node = umis.select(CATEGORY, "umi", "n")
    pairs = hamming_pairs(node, distance)
    n = node.select(CATEGORY, F.col("umi").alias("x"), F.col("n").alias("nx"))
    p = pairs.join(n.withColumnsRenamed({"x": "a", "nx": "na"}), [CATEGORY, "a"]).join(n.withColumnsRenamed({"x": "b", "nx": "nb"}), [CATEGORY, "b"])
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # rank orders early before late: falling count, rising name
    edges = cut(p.select(CATEGORY, F.when(first, F.col("a")).otherwise(F.col("b")).alias("early"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("late"), F.when(first, F.col("na")).otherwise(F.col("nb")).alias("early_n")))
    state = cut(node.select(CATEGORY, "umi", F.lit(None).cast("string").alias("family")))
    while True:
        known = state.select(CATEGORY, F.col("umi").alias("early"), F.col("family").alias("of"))
        rank = F.struct((-F.col("early_n")).alias("r"), F.col("early").alias("e"))
        seen = edges.join(known, [CATEGORY, "early"]).groupBy(CATEGORY, F.col("late").alias("umi")).agg(F.min(F.when(F.col("of") == F.col("early"), rank)).alias("parent"), F.min(F.when(F.col("of").isNull(), rank)).alias("open"))
        joined = state.join(seen, [CATEGORY, "umi"], "left")
        claimed = F.col("parent").isNotNull() & (F.col("open").isNull() | (F.col("parent") < F.col("open")))
        new = F.when(F.col("family").isNotNull(), F.col("family")).when(claimed, F.col("parent.e")).when(F.col("parent").isNull() & F.col("open").isNull(), F.col("umi"))
        before, state = state, cut(joined.select(CATEGORY, "umi", new.alias("family")))
        let_go(before)
        if state.where("family is null").isEmpty():
            return node.join(state, [CATEGORY, "umi"]).select(CATEGORY, "umi", "n", F.col("family").alias("umi_family"))


def families(events: DataFrame, model: str = FamilyModel.AUTO, distance: int = 1, min_fraction: float = 0.005, risk_limit: float = 0.05, coverage: float = 0.10, task_umis: int = TASK_UMIS) -> DataFrame:
    """``events`` with family, family size and share, model used and the numbers behind the choice."""
    umis = cut(counts(events))  # one row per exact UMI: the reads are not read again for each use below
    per_umi, choice = assigned(umis, model, distance, min_fraction, risk_limit, coverage, task_umis)
    return with_families(events, _narrow(per_umi), _narrow(choice))


def _narrow(df: DataFrame) -> DataFrame:
    """A table to join reads with, stored; sent to all tasks if it has few rows, so that the reads are not shuffled for it."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def with_families(events: DataFrame, per_umi: DataFrame, choice: DataFrame) -> DataFrame:
    return events.join(per_umi, [CATEGORY, "umi"], "left").join(choice, CATEGORY)


def assigned(umis: DataFrame, model: str = FamilyModel.AUTO, distance: int = 1, min_fraction: float = 0.005, risk_limit: float = 0.05, coverage: float = 0.10, task_umis: int = TASK_UMIS) -> tuple[DataFrame, DataFrame]:
    """Of stored counts: family, its size and share of each UMI that has one; and one row for each category with the model used."""
    model = FamilyModel(model)
    choice = decisions(umis, model, distance, risk_limit, coverage)
    if model is FamilyModel.MAX:
        found = max_model(umis)
    elif model is FamilyModel.AUTO:
        chosen = umis.join(choice.select(CATEGORY, "umi_model_used"), CATEGORY)
        found = max_model(chosen.where(F.col("umi_model_used") == FamilyModel.MAX.value).drop("umi_model_used"))
        found = found.unionByName(cluster(chosen.where(F.col("umi_model_used") == FamilyModel.CLUSTER.value).drop("umi_model_used"), distance, min_fraction, task_umis))
    else:
        found = cluster(umis, min(255, distance + (model is FamilyModel.CLUSTER_PLUS_ONE)), min_fraction, task_umis)
    if model is not FamilyModel.MAX:
        found = cut(found)
    # sizes from the counts, not from the reads: rows are one per distinct UMI
    sized = umis.join(found, [CATEGORY, "umi"], "left")
    reads = sized.groupBy(CATEGORY).agg(F.sum("n").alias("reads"))
    size = sized.where("umi_family is not null").groupBy(CATEGORY, "umi_family").agg(F.sum("n").alias("umi_family_size"))
    per_umi = found.join(size, [CATEGORY, "umi_family"]).join(reads, CATEGORY).select(CATEGORY, "umi", "umi_family", "umi_family_size", (F.col("umi_family_size") / F.col("reads")).alias("umi_family_fraction"))
    return per_umi, choice


def histogram(umis: DataFrame) -> DataFrame:
    """How many UMIs have how many reads."""
    return umis.groupBy("n").agg(F.count("*").alias("umis")).withColumnRenamed("n", "reads")


def parent_rank(umis: DataFrame, partitions: int | None = None) -> DataFrame:
    """Order in which UMIs may become parents: by falling count, then by name, from 1 in each category.

    Ranges of (category, count, name) are sorted by a task each, so a category of
    all rows is spread over all tasks.  What a range counts before a category's
    rows is taken off, what earlier ranges hold of the category added: a sum over
    one row for each category and range.
    """
    partitions = partitions or int(umis.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(CATEGORY), F.desc("n"), F.col("umi")]
    numbered = umis.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = cut(numbered.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)}))
    parts = rows.groupBy(CATEGORY, "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    every = parts.groupBy(CATEGORY).agg(F.array_sort(F.collect_list(F.struct("part", "first", "held"))).alias("ps"))
    before = lambda p: F.aggregate(F.filter("ps", lambda q: q["part"] < p["part"]), F.lit(0).cast("bigint"), lambda a, q: a + q["held"])
    offset = every.select(F.col(CATEGORY).alias("of"), F.explode(F.transform("ps", lambda p: F.struct(p["part"].alias("in"), (before(p) - p["first"] + 1).alias("add")))).alias("o")).select("of", "o.*")
    placed = rows.join(offset, F.col(CATEGORY).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return placed.select(*umis.columns, (F.col("at") + F.col("add")).alias("parent_rank"))


def check_space(n: int, length: int) -> None:
    if n > 4**length:
        raise ValueError(f"{n} distinct UMIs do not fit in {length} bases")
