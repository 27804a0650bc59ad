"""Strain dictionaries, the ordered search patterns they give, and run settings."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from enum import StrEnum

# ---- fixed values: site sequences of the strains, in genome order
NL43 = {
    "D4_breakpoint_position": "5301",
    "A7_breakpoint_position": "7625",
    "D1": "GGGGCGGCGACTG",
    "D1-unspliced": "GTGAGTACGCC",
    "gag-AUG": "GAGAGATGGGTGC",
    "A1": "GGACAGCAGAGATCCA",
    "D2": "CTCTGGAAAG",
    "D2-unspliced": "GTGAAGGGGC",
    "D2b": "CAGATGGCAG",
    "D2b-unspliced": "GTGATGATTG",
    "A2": "AATCTGCTATAAGAAA",
    "D3": "ACATAACAAG",
    "D3-unspliced": "GTAGGATCTC",
    "A3": "AATTGGGTGTCGACAT",
    "A4d": "TGTTGCTTTCATTGC",
    "A4c": "TTTGTTTCATGACAA",
    "A4a": "CCTTAGGCATCTCCTA",
    "A4b": "GCATCTCCTATGGCAG",
    "A5a": "GAAGAAGCGGAGACAG",
    "A5b": "AAGCGGAGACAGCGA",
    "A7": "ACCCACCTCCCAATC",
}
#: What the other strains change.
VARIANTS = {
    "nl43": {},
    "nl43_t745a": {"D1-unspliced": "GAGAGTACGCC"},
    "nl43_t745c": {"D1-unspliced": "GCGAGTACGCC"},
    "nl43_d3": {"D1": "GGGGCGGCGACTGA", "D1-unspliced": "GTACGCCAAAAA"},
}
#: Acceptors in the order of precedence that every search list ends with.
COMMON = ("A3", "A4d", "A4c", "A4a", "A4b", "A5a", "A5b", "A7")
#: Acceptor bases used after D3.
D3_ACCEPTOR_BASES = 6
#: Bases of the unspliced continuation that belong to the second donor downstream of D1.
D1PRIME_SHIFT = 4
FORWARD_N, UMI_BASES = 4, 14
# ---- end of fixed values


class Assay(StrEnum):
    RANDOM_REVERSE = "random-reverse"
    K_MER = "k-mer"
    SIZE_SPECIFIC = "size-specific"

    @property
    def in_file_names(self) -> str:
        return "kmer" if self is Assay.K_MER else self.value


class FamilyModel(StrEnum):
    MAX = "max-model"
    CLUSTER = "cluster-model"
    CLUSTER_PLUS_ONE = "cluster-model-plusone"
    AUTO = "auto-model"


@dataclass(frozen=True)
class Step:
    acceptor: str
    pattern: str


@dataclass(frozen=True)
class SpliceConfig:
    """Everything a task needs to read a chain; small, and shipped in the closure."""

    strain: str
    assay: Assay
    distance: int
    sites: dict[str, str]
    genome: str
    d1_to_all: tuple[Step, ...] = ()
    d1prime_to_all: tuple[Step, ...] = ()
    alternative_d1_to_all: tuple[Step, ...] = ()
    d2_to_all: tuple[Step, ...] = ()
    d2b_to_all: tuple[Step, ...] = ()
    d3_to_all: tuple[Step, ...] = ()

    @property
    def d4_breakpoint(self) -> int:
        return int(self.sites["D4_breakpoint_position"])

    @property
    def a7_breakpoint(self) -> int:
        return int(self.sites["A7_breakpoint_position"])


def strain_sites(strain: str, toml_text: str | None = None) -> dict[str, str]:
    """Site dictionary of a strain, from the built-in ones or a TOML text of tables by strain."""
    known = {k: {n: str(v) for n, v in t.items()} for k, t in tomllib.loads(toml_text).items()} if toml_text else {k: NL43 | v for k, v in VARIANTS.items()}
    if (name := strain.lower()) not in known:
        raise ValueError(f"unknown strain {strain!r}; known: {', '.join(sorted(known))}")
    return known[name]


def _steps(sites: dict[str, str], donor: str | None, acceptors: tuple[str, ...]) -> tuple[Step, ...]:
    out = []
    for a in acceptors:
        if a == "gag-AUG" or donor is None:
            pattern = sites[a]
        elif donor == "D3":
            pattern = sites["D3"] + sites[a][:D3_ACCEPTOR_BASES]
        else:
            pattern = sites[donor] + sites[a]
        out.append(Step(a, pattern))
    return tuple(out)


def build_config(strain: str = "nl43", assay: str = Assay.RANDOM_REVERSE, distance: int = 1, genome: str = "", toml_text: str | None = None) -> SpliceConfig:
    """Ordered search lists of a strain.  ``genome`` is the reference sequence that size classes are looked up in."""
    sites = strain_sites(strain, toml_text)
    moved = sites | {"D1": sites["D1"] + sites["D1-unspliced"][:D1PRIME_SHIFT], "D1-unspliced": sites["D1-unspliced"][D1PRIME_SHIFT:]}
    return SpliceConfig(
        strain.lower(), Assay(assay), distance, sites, genome.upper(),
        d1_to_all=_steps(sites, "D1", ("D1-unspliced", "gag-AUG", "A1", "A2", *COMMON)),
        d1prime_to_all=_steps(moved, "D1", ("D1-unspliced", "A1", "A2", *COMMON)),
        alternative_d1_to_all=_steps(sites, None, ("A1", "A2", *COMMON, "gag-AUG")),
        d2_to_all=_steps(sites, "D2", ("D2-unspliced", "A2", *COMMON)),
        d2b_to_all=_steps(sites, "D2b", ("D2b-unspliced", "A2", *COMMON)),
        d3_to_all=_steps(sites, "D3", ("D3-unspliced", *COMMON)),
    )


@dataclass(frozen=True)
class RunConfig:
    """Settings of one run; checked on construction."""

    strain: str = "nl43"
    distance: int = 1
    family_model: FamilyModel = FamilyModel.AUTO
    min_fraction: float = 0.005
    neighbor_risk: float = 0.05
    coverage_ratio: float = 0.10
    header: str | None = None
    r1: str = ""
    r2: str = ""
    assay: Assay = Assay.RANDOM_REVERSE
    out: str = "."
    genome: str = field(default="", repr=False)
    isoforms: str | None = None

    def __post_init__(self) -> None:
        from .functions.seq import is_iupac

        object.__setattr__(self, "family_model", FamilyModel(self.family_model))
        object.__setattr__(self, "assay", Assay(self.assay))
        if not 0 <= self.min_fraction <= 1:
            raise ValueError("the minimum fraction must lie in [0, 1]")
        if not 0 <= self.neighbor_risk < float("inf"):
            raise ValueError("the neighbour risk must be finite and not negative")
        if not 0 <= self.distance <= 255:
            raise ValueError("the distance must lie in 0..255")
        if self.header is not None and not is_iupac(self.header):
            raise ValueError(f"not an IUPAC pattern: {self.header!r}")

    @property
    def stem(self) -> str:
        return f"output_strain_{self.strain}_distance_{self.distance}_assay_{self.assay.in_file_names}"
