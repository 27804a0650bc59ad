"""Splice chains of exact searches as one column expression: no Python worker, no join, no shuffle.

The stages of a read are the steps of one ``aggregate`` over a state: which stage
is next, what is left of the sequence, the chain so far and the two contexts.  A
stage looks for its patterns in their order, takes the first that occurs and cuts
the sequence to begin with it.  Acceptors without D1 are looked for with one edit
even here, as the reader does.

It serves clusters without Python workers: give ``splice_chain`` of this module to
``chain.events``.  Where there are workers, the UDF is several times as fast, as it
searches a batch at a time.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Assay, SpliceConfig
from ..functions import seq
from ..functions.columns import let
from .chain import CONTEXT, MOST_SLICES

#: Bases of the pieces by which overlaps are found, and stages that a read can pass.
PIECE, STAGES = 8, 10
#: Bases of the pieces that are looked up in the genome.
SHORTEST, LONGEST = 10, 20
STATE = "struct<stage:int,s:string,chain:array<string>,alt:string,beyond:string>"


def exact(s: Column, pattern: str) -> Column:
    """Place of the first occurrence, from 1, or NULL."""
    return F.when(s.contains(pattern), F.locate(pattern, s))


def one_edit(s: Column, pattern: str) -> Column:
    """Place where the best match within one edit begins: least distance, then first end, then as long as the pattern, then longer.

    One edit leaves a half of the pattern as it is: ends are looked at only near an
    unchanged half.
    """
    m, half = len(pattern), len(pattern) // 2
    a, b = pattern[:half], pattern[half:]

    def near(e: Column) -> Column:
        around = F.substr(s, F.greatest(e - (m + 1), F.lit(0)) + 1, F.lit(m + 2))
        return around.contains(a) | around.contains(b)

    def scores(e: Column) -> Column:
        one = lambda n, rank: F.when(e >= n, F.levenshtein(F.substr(s, e - n + 1, F.lit(n)), F.lit(pattern)) * 1_000_000 + e * 10 + rank)
        return F.least(one(m, 0), one(m + 1, 1), one(m - 1, 2))

    ends = F.filter(F.sequence(F.lit(1), F.length(s)), near)
    begin = lambda best: F.when(best < 2_000_000, F.floor(best % 1_000_000 / 10).cast("int") - F.when(best % 10 == 0, m).when(best % 10 == 1, m + 1).otherwise(m - 1) + 1)
    inexact = F.when(s.contains(a) | s.contains(b), let(F.array_min(F.transform(ends, scores)), begin))
    return F.coalesce(exact(s, pattern), inexact)


def _first(s: Column, steps: list[tuple[str, str]], find=exact) -> Column:
    """The first of (name, pattern) that occurs: struct of name and place, or NULL."""

    def named(name: str):
        return lambda at: F.when(at.isNotNull(), F.struct(F.lit(name).alias("a"), at.alias("p")))

    return F.coalesce(*[let(find(s, p), named(name)) for name, p in steps])


def _step(st: Column, c: SpliceConfig) -> Column:
    s, stage, chain, d1 = st["s"], st["stage"], st["chain"], len(c.sites["D1"])
    site = lambda name: _first(s, [(name, c.sites[name])])
    of = lambda steps, find=exact: _first(s, [(x.acceptor, x.pattern) for x in steps], find)
    looked = (
        F.when(stage == 1, site("D1")).when(stage == 2, of(c.d1_to_all)).when(stage == 3, site("D2")).when(stage == 4, of(c.d2_to_all)).when(stage == 5, site("D3"))
        .when(stage == 6, site("D2b")).when(stage == 7, of(c.d3_to_all)).when(stage == 8, of(c.alternative_d1_to_all, one_edit)).when(stage == 9, of(c.d1prime_to_all)).when(stage == 10, of(c.d2b_to_all))
    )
    far = F.length(s) > d1 + 4

    def after(h: Column) -> Column:
        none, name = h.isNull(), h["a"]
        missed = F.when(stage == 1, 8).when(stage == 2, 9).when((stage == 9) & far, 8).otherwise(0)
        onward = (
            F.when(stage == 1, 2).when(stage == 3, 4).when(stage == 5, 7).when(stage == 6, 10).when((stage == 4) & (name == "D2-unspliced"), 6)
            .when(stage.isin(2, 8, 9) & (name == "A1"), 3).when((stage != 7) & (name == "A2"), 5).otherwise(0)
        )
        lost = F.when(stage == 1, F.lit("noD1")).when(stage == 3, F.lit("noD2")).when(stage == 5, F.lit("noD3")).when(stage == 6, F.lit("noD2b")).when(stage == 8, F.lit("no-acceptor")).otherwise(F.lit("unknown"))
        events = (
            F.when(none, F.when(stage == 9, chain).otherwise(F.array_append(chain, lost)))
            .when(stage == 9, F.array(F.lit("D1prime"), name))
            .when((stage == 8) & (name == "gag-AUG"), F.concat(chain, F.array(name, F.lit("unspliced"))))
            .otherwise(F.array_append(chain, name))
        )
        before = F.substr(s, F.greatest(h["p"] - CONTEXT, F.lit(1)), h["p"] - F.greatest(h["p"] - CONTEXT, F.lit(1)))
        beyond = F.when(none & (stage == 2), F.substring(s, d1 + 1, CONTEXT)).when(none & (stage == 9) & far, F.substring(s, d1 + 5, CONTEXT)).otherwise(st["beyond"])
        new = F.struct(
            F.when(none, missed).otherwise(onward).alias("stage"), F.when(none, s).otherwise(F.substr(s, h["p"])).alias("s"), events.alias("chain"),
            F.when((stage == 8) & ~none, before).otherwise(st["alt"]).alias("alt"), beyond.alias("beyond"),
        )
        return new.cast(STATE)

    return F.when(stage == 0, st).otherwise(let(looked, after))


def read(s: Column, config: SpliceConfig) -> Column:
    """Struct of chain, s (the tail from the last recognised site on), alt and beyond of a sequence."""
    start = F.struct(F.lit(1).alias("stage"), s.alias("s"), F.array().cast("array<string>").alias("chain"), F.lit(None).cast("string").alias("alt"), F.lit(None).cast("string").alias("beyond")).cast(STATE)
    return F.aggregate(F.sequence(F.lit(1), F.lit(STAGES)), start, lambda st, _: _step(st, config))


def overlap(a: Column, b: Column, least: int = 10, rate: float = 0.02) -> Column:
    """The longest overlap of a's end with b's beginning with mismatches up to overlap x rate, or NULL.

    With k mismatches one of the first k + 1 pieces of b is unchanged in a: its
    places there give the overlaps that are looked at.  Sizes are tried from the
    largest down, so the first that holds is the result.
    """
    pair = F.struct(a.alias("a"), b.alias("b"), F.least(F.length(a), F.length(b)).alias("n"))

    def places(a: Column, n: Column, piece: Column, at: Column) -> Column:
        """Sizes of overlaps in which a piece of b that begins at ``at`` lies where it occurs in a."""
        # cut before every place of the piece: a cut leaves of ``a`` what follows it
        cuts = F.split(a, F.concat(F.lit(r"(?=\Q"), piece, F.lit(r"\E)")))
        start = F.struct(F.length(a).alias("left"), F.array().cast("array<int>").alias("all")).cast("struct<left:int,all:array<int>>")
        lefts = F.aggregate(cuts, start, lambda st, x: F.struct((st["left"] - F.length(x)).alias("left"), F.array_append(st["all"], st["left"]).alias("all")), lambda st: st["all"])
        places_ = F.when(a.startswith(piece), lefts).otherwise(F.slice(lefts, F.lit(2), F.length(a)))
        sizes = F.filter(F.transform(places_, lambda left: left + at), lambda o: (o >= least) & (o <= n))
        return F.when((F.length(piece) == PIECE) & a.contains(piece), sizes).otherwise(F.array().cast("array<int>"))

    def candidates(p: Column) -> Column:
        pieces = F.sequence(F.lit(0), F.floor(p["n"] * rate).cast("int"))
        found = F.flatten(F.transform(pieces, lambda j: let(F.substr(p["b"], PIECE * j + 1, F.lit(PIECE)), lambda piece: places(p["a"], p["n"], piece, PIECE * j))))
        return F.sort_array(F.array_distinct(found), asc=False)

    def holds(p: Column, o: Column) -> Column:
        x, y, most = F.right(p["a"], o), F.left(p["b"], o), F.floor(o * rate).cast("int")
        la = F.length(p["a"])
        # one of the last pieces is unchanged too: repeats that end elsewhere need no more than a look at these
        end = F.exists(F.sequence(F.lit(1), most + 1), lambda j: F.substr(p["a"], la - PIECE * j + 1, F.lit(PIECE)) == F.substr(p["b"], o - PIECE * j + 1, F.lit(PIECE)))
        # equal texts hold; of others those with more edits than mismatches allowed need no count of these
        close = F.call_function("levenshtein", x, y, most) >= 0
        wrong = let(F.struct(x.alias("x"), y.alias("y")), lambda z: F.size(F.filter(F.sequence(F.lit(1), o), lambda i: F.substr(z["x"], i, F.lit(1)) != F.substr(z["y"], i, F.lit(1)))))
        return (x == y) | ((most > 0) & (end | (o < PIECE * (most + 1))) & close & (wrong <= o * rate))

    def largest(p: Column) -> Column:
        return F.aggregate(candidates(p), F.lit(None).cast("int"), lambda best, o: F.when(best.isNotNull(), best).when(holds(p, o), o))

    return let(pair, lambda p: F.when(p["n"] >= max(least, PIECE), largest(p)))


def _first_places(genome: str, length: int) -> tuple[Column, int]:
    """A function's table: by crc32 of a word of ``length`` bases, modulo the table's size, where such words begin, with what follows.

    A genome is a constant, so this is one literal; a search looks a word up and does not read the genome.
    """
    size = max(1, len(genome))
    buckets: list[list[str]] = [[] for _ in range(size)]
    for at in range(len(genome) - length + 1):
        buckets[zlib.crc32(genome[at : at + length].encode()) % size].append(f"{at}:{genome[at : at + LONGEST]}")
    return F.split(F.lit("|".join(",".join(x) for x in buckets)), r"\|"), size


def size_class(chain: Column, tail: Column, config: SpliceConfig) -> Column:
    low, high = config.d4_breakpoint, config.a7_breakpoint
    first = F.get(F.filter(chain, lambda e: e.isin("A7", "unknown", "no-acceptor", "D1-unspliced", "gag-AUG")), 0)
    table, size = _first_places(config.genome, SHORTEST)

    def place(piece: Column) -> Column:
        """Where a piece of SHORTEST to LONGEST bases occurs first in the genome, from 0, or -1: places of a bucket are in order."""
        bucket = F.get(table, F.pmod(F.crc32(F.left(piece, F.lit(SHORTEST))), F.lit(size)).cast("int"))
        found = lambda x: let(F.position(F.concat(F.lit(":"), piece), x), lambda at: F.when(at > 0, F.substring_index(F.left(x, at - 1), ",", -1).cast("int")))
        return F.coalesce(let(bucket, found), F.lit(-1))

    if config.assay is Assay.RANDOM_REVERSE:
        pieces = F.slice(seq.slices_from_end(tail), 1, MOST_SLICES)
        some = lambda ps, test: F.exists(ps, test)
        rule = lambda ps: F.when(some(ps, lambda p: (p > low) & (p < high)), "4kb").when(some(ps, lambda p: p > high), "1.8kb").when(some(ps, lambda p: p < low), "Both").otherwise("Unknown")
        by_place = let(F.filter(F.transform(pieces, place), lambda p: p >= 0), rule)
    else:
        between = F.lit("4kb") if config.assay is Assay.K_MER else None
        rule = lambda p: F.when(p < 0, "Unknown").when(p > high, "1.8kb").when(p < low, "4kb").otherwise(between if between is not None else F.lit("Unknown"))
        by_place = F.when(F.length(tail) < 30, "Unknown").otherwise(let(place(F.left(F.right(tail, F.lit(30)), F.lit(15))), rule))
    return let(first, lambda e: F.when(e == "A7", "1.8kb").when(e.isin("unknown", "no-acceptor"), "Unknown").when(e.isNotNull(), "Unspliced").otherwise(by_place))


def splice_chain(config: SpliceConfig):
    """(forward sequence, reverse sequence) -> the struct of ``chain.splice_chain``, for a distance of 0."""
    if config.distance:
        raise ValueError("chains without a Python worker are for exact searches")

    def run(forward: str, reverse: str) -> Column:
        a, b = F.col(forward), seq.reverse_complement(F.col(reverse))

        def joined(b: Column) -> Column:
            return let(overlap(a, b), lambda o: F.struct(F.when(o.isNotNull(), F.concat(a, F.substr(b, o + 1))).alias("joined"), F.when(o.isNotNull(), F.concat(a, F.substr(b, o + 1))).otherwise(F.concat(a, b)).alias("s")))

        def events(x: Column) -> Column:
            return let(read(x["s"], config), lambda r: F.struct(
                x["joined"].alias("joined"), r["chain"].alias("chain"), r["s"].alias("tail"), r["alt"].alias("alternative_d1_used"), r["beyond"].alias("unknown_sequence_after_d1"), size_class(r["chain"], r["s"], config).alias("size_class")
            ))

        return let(let(b, joined), events)

    return run
