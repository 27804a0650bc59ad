"""Column builders for sequences: all JVM-side, no Python worker."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FORWARD_N, UMI_BASES
from .columns import let

# ---- fixed values: IUPAC codes as sets of bases (A=1, C=2, G=4, T=8), and complements
IUPAC = {"A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}
BASES, COMPLEMENTS = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"
HOMOPOLYMER = 11
# ---- end of fixed values


def is_iupac(pattern: str) -> bool:
    return bool(pattern) and all(c in IUPAC for c in pattern.upper())


def reverse_complement(s: Column) -> Column:
    """Case is kept; codes outside the alphabet stay as they are."""
    return F.reverse(F.translate(s, BASES, COMPLEMENTS))


def split_reads(r1: Column, r2: Column) -> dict[str, Column]:
    """The four parts of a pair, upper-case; rows shorter than the parts are for ``readable`` to drop."""
    a, b = F.upper(r1), F.upper(r2)
    return {"forward_ns": F.substring(a, 1, FORWARD_N), "forward_sequence": F.substring(a, FORWARD_N + 1, 1 << 30), "umi": F.substring(b, 1, UMI_BASES), "reverse_sequence": F.substring(b, UMI_BASES + 1, 1 << 30)}


def readable(r1: Column, r2: Column) -> Column:
    return (F.length(r1) >= FORWARD_N) & (F.length(r2) >= UMI_BASES)


def homopolymer_pattern(bases: str = "ACGTN", run: int = HOMOPOLYMER) -> str:
    """A maximal run of ``run`` or more equal bases that touches neither end; RE2 reads it too."""
    return "|".join(f"[^{b}]{b}{{{run},}}[^{b}]" for b in bases)


def has_homopolymer(s: Column, bases: str = "ACGTN") -> Column:
    """Whether such a run occurs; the pattern is only tried on reads that hold a run at all, most hold none."""
    pattern = homopolymer_pattern(bases)
    return let(s, lambda x: reduce(or_, [x.contains(b * HOMOPOLYMER) for b in bases]) & x.rlike(pattern))


def iupac_set(base: Column) -> Column:
    """Base set of a one-character column; 0 for what is no code."""
    pairs = [F.lit(x) for kv in IUPAC.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.upper(base)), F.lit(0))


def header_matches(read: Column, pattern: str, mismatches: int) -> Column:
    """The read's first bases against an IUPAC pattern: sets must overlap, up to ``mismatches`` times not; short reads fail."""
    if not is_iupac(pattern):
        raise ValueError(f"not an IUPAC pattern: {pattern!r}")
    # one membership test per position, folded into one sum
    wrong = [F.when(F.substring(F.upper(read), i + 1, 1).isin([b for b, m in IUPAC.items() if m & IUPAC[c]]), 0).otherwise(1) for i, c in enumerate(pattern.upper())]
    total = wrong[0]
    for w in wrong[1:]:
        total = total + w
    return (F.length(read) >= len(pattern)) & (total <= mismatches)


def slices_from_end(s: Column, size: int = 20, skip: int = 15, least: int = 10) -> Column:
    """Pieces of ``size`` bases from right to left after the last ``skip``; the last piece may be shorter, down to ``least``."""
    n = F.length(s) - skip
    ends = F.when(n >= least, F.sequence(n, F.greatest(F.lit(least), F.least(n, F.lit(least))), F.lit(-size))).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda e: F.substring(s, F.greatest(e - size, F.lit(0)) + 1, F.least(e, F.lit(size))))


def packed(umi: Column, length: int) -> Column:
    """Up to 16 bases as nibbles of one BIGINT (A=1, C=2, G=4, T=8, other 15)."""
    if length > 16:
        raise ValueError("16 bases at most")
    out = F.lit(0).cast("bigint")
    for i in range(length):
        code = iupac_set(F.substring(umi, i + 1, 1))
        out = F.shiftleft(out, 4).bitwiseOR(F.when(code == 0, 15).otherwise(code).cast("bigint"))
    return out


def mismatches(a: Column, b: Column, length: int) -> Column:
    """Hamming distance of two packed sequences of equal length."""
    x = a.bitwiseXOR(b)
    folded = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
    return F.bit_count(folded.bitwiseAND(F.lit(int("1" * max(1, min(length, 15)), 16)).cast("bigint") if length < 16 else F.lit(0x1111111111111111).cast("bigint")))


def chunk_bounds(length: int, chunks: int) -> list[tuple[int, int]]:
    """Start and end of near-equal chunks, the longer ones first."""
    size, more = divmod(length, chunks)
    out, at = [], 0
    for i in range(chunks):
        to = at + size + (i < more)
        out.append((at, to))
        at = to
    return out


def exact_overlap(r1: Column, rc: Column, least: int = 10) -> Column:
    """Longest suffix of ``r1`` that is a prefix of ``rc``, of ``least`` bases or more; NULL if there is none."""
    n = F.least(F.length(r1), F.length(rc))
    pair = F.struct(F.right(r1, n).alias("a"), F.left(rc, n).alias("b"))

    def longest(p: Column) -> Column:
        # an overlap begins where the first bases of rc occur in r1: the first such place mostly decides
        at, size = F.position(F.left(p["b"], F.lit(least)), p["a"]), F.length(p["a"])
        begins = lambda o: p["b"].startswith(F.right(p["a"], o))
        return F.when((size >= least) & (at > 0), let(size - at + 1, lambda o: F.when(begins(o), o).otherwise(F.get(F.filter(_falling(o - 1, least), begins), 0))))

    return let(pair, longest)


def _falling(top: Column, least: int) -> Column:
    """The whole numbers from ``top`` down to ``least``."""
    return F.when(top >= least, F.sequence(top, F.lit(least), F.lit(-1))).otherwise(F.array().cast("array<int>"))
