"""Mock read pairs of known chains, made with column expressions.

The chain is in the read's id.  Spacers hold no runs of equal bases, so the
homopolymer filter keeps them.  Pseudo-random choices are hashes of the row and a
seed: the same rows give the same reads on any cluster.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import UMI_BASES, strain_sites
from ..functions.columns import let
from ..functions.seq import reverse_complement
from ..operators.umi import check_space

SPACER = "CTATCTCATACTCATCATAC"
READ_BASES, TAIL_BASES = 300, 286
#: Where on the genome the second read comes from, and the size class it shows.
WINDOWS = ((5000, "Both"), (7000, "4kb"), (8000, "1.8kb"), (None, "Unknown"))


def pseudo_genome(bases: int = 8966, seed: str = "genome") -> str:
    """A fixed random sequence, for tests and mock data without a genome file."""
    text = "".join(hashlib.md5(f"{seed}-{i}".encode()).hexdigest() for i in range(bases // 32 + 1))
    return text.translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"))[:bases]


def unit(*parts: Column | str, seed: int = 7) -> Column:
    """A number in [0, 1) from a hash."""
    return (F.xxhash64(F.lit(seed), *[F.lit(p) if isinstance(p, str) else p for p in parts]).bitwiseAND((1 << 53) - 1)) / float(1 << 53)


def random_bases(n: int, *parts: Column, seed: int = 7) -> Column:
    text = F.concat(*[F.translate(F.md5(F.concat_ws("-", F.lit(f"{seed}.{i}"), *[p.cast("string") for p in parts])), "0123456789abcdef", "ACGTACGTACGTACGT") for i in range(n // 32 + 1)])
    return F.substring(text, 1, n)


def mutated(s: Column, rate: float, *parts: Column, seed: int = 7) -> Column:
    """Each base replaced by one of the other three with probability ``rate``."""
    others = F.create_map(*[F.lit(x) for b in "ACGT" for x in (b, "ACGT".replace(b, ""))])

    def base(of: Column, i: Column) -> Column:
        b = F.substring(of, i, 1)
        pick = (unit(i, *parts, seed=seed + 1) * 3).cast("int") + 1
        return F.when(unit(i, *parts, seed=seed) < rate, F.coalesce(F.substring(F.element_at(others, b), pick, 1), b)).otherwise(b)

    # made once a row, not once for each of its bases
    return let(s, lambda of: F.array_join(F.transform(F.sequence(F.lit(1), F.length(of)), lambda i: base(of, i)), ""))


def padded(s: Column, bases: int = READ_BASES) -> Column:
    filler = (SPACER * (bases // len(SPACER) + 1))[:bases]
    return F.when(F.length(s) < bases, F.concat(s, F.substring(F.lit(filler), F.lit(1), bases - F.length(s)))).otherwise(s)


def site_sequence(form: Column, sites: dict[str, str]) -> Column:
    """Sequences of a form's events; events that are no acceptor and no continuation follow a spacer; unknown ones are filler."""
    known = F.create_map(*[F.lit(x) for kv in sites.items() for x in kv])
    events = F.split(form, "_")
    one = lambda e: F.concat(F.when(e.rlike("^(?:A.*|.*un.*)$"), "").otherwise(SPACER), F.coalesce(F.element_at(known, e), F.lit(SPACER[:10])))
    return F.when(F.element_at(events, 1) == "noD1", F.lit("")).otherwise(F.concat(F.lit(sites["D1"]), F.array_join(F.transform(F.slice(events, 2, 20), one), "")))


def reads(rows: DataFrame, form: str, key: str, genome: str, strain: str = "nl43", umis_per_form: int = 100, error_rate: float = 0.005, seed: int = 7) -> DataFrame:
    """(read_ix, id, r1, r2) for rows that have a form and a unique integer key."""
    sites = strain_sites(strain)
    k, f = F.col(key), F.col(form)
    window = (unit(k, seed=seed + 2) * len(WINDOWS)).cast("int")
    tail, tag = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (at, name) in reversed([*enumerate(WINDOWS)]):
        text = genome[at : at + TAIL_BASES] if at is not None and at + TAIL_BASES <= len(genome) else (SPACER * 15)[:TAIL_BASES]
        tail, tag = F.when(window == i, text).otherwise(tail), F.when(window == i, name).otherwise(tag)
    # a few UMIs are frequent: the index is the smaller of two draws
    index = (F.least(unit(k, seed=seed + 3), unit(k, seed=seed + 4)) * umis_per_form).cast("int")
    umi = mutated(random_bases(UMI_BASES, f, index, seed=seed), error_rate, k, seed=seed + 5)
    r1 = padded(F.concat(random_bases(4, f, seed=seed), F.lit(SPACER), site_sequence(f, sites)))
    return rows.select(k.cast("bigint").alias("read_ix"), F.concat_ws("_", F.lit("mock"), f, tag, k.cast("string")).alias("id"), r1.alias("r1"), F.concat(umi, reverse_complement(tail)).alias("r2"))


def allotted(spark: SparkSession, ratios: dict[str, float], total: int) -> DataFrame:
    """(read_ix, form): ``total`` rows dealt to forms in proportion."""
    bounds, at, names = [], 0.0, []
    whole = sum(ratios.values())
    for name, r in ratios.items():
        at += r / whole
        bounds.append(at)
        names.append(name)
    pick = F.lit(names[-1])
    for b, name in zip(reversed(bounds[:-1]), reversed(names[:-1])):
        pick = F.when(F.col("id") < int(b * total), name).otherwise(pick)
    return spark.range(total).select(F.col("id").alias("read_ix"), pick.alias("form"))


def simulated_umis(rows: DataFrame, length: int, targets: int, seed: int = 10, error_rate: float = 0.005) -> DataFrame:
    """(umi, n): one read of ``targets`` UMIs for each id, the middle ones most often, with errors."""
    check_space(targets, length)
    normal = F.sqrt(-2 * F.log(1 - unit(F.col("id"), seed=seed))) * F.cos(6.283185307179586 * unit(F.col("id"), seed=seed + 1))
    index = F.greatest(F.lit(0), F.least(F.lit(targets - 1), F.round(normal * (targets / 6) + targets / 2).cast("int")))
    umi = mutated(random_bases(length, index, seed=seed), error_rate, F.col("id"), seed=seed + 2)
    return rows.select(umi.alias("umi")).groupBy("umi").agg(F.count("*").alias("n"))
