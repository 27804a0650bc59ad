"""The splice chain at distance 0 or 1 as SQL, for DuckDB: a twin of the engine's reader, written from the stage table.

A stage looks for its patterns in their order; the first that occurs is kept and
the sequence cut to begin with it.  The recursion carries the stage, the chain and
the sequence of every read; stage 0 is the end.
"""

from __future__ import annotations

# ---- fixed values: site sequences of the default strain, and the acceptors that each stage looks for, in order
SITES = {
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
LAST = "A3 A4d A4c A4a A4b A5a A5b A7"
STAGES = {
    "D1": f"D1-unspliced gag-AUG A1 A2 {LAST}",
    "D1prime": f"D1-unspliced A1 A2 {LAST}",
    "alternative D1": f"A1 A2 {LAST} gag-AUG",
    "D2": f"D2-unspliced A2 {LAST}",
    "D2b": f"D2b-unspliced A2 {LAST}",
    "D3": f"D3-unspliced {LAST}",
}
D4, A7 = 5301, 7625
# ---- end of fixed values


def pattern(stage: str, acceptor: str) -> str:
    """What is looked for: donor and acceptor together, but for gag-AUG, for no donor, and for D3, which takes six bases of the acceptor."""
    s = SITES
    if acceptor == "gag-AUG" or stage == "alternative D1":
        return s[acceptor]
    if stage == "D3":
        return s["D3"] + s[acceptor][:6]
    if stage == "D1prime":  # the donor four bases on
        return s["D1"] + s["D1-unspliced"][:4] + (s["D1-unspliced"][4:] if acceptor == "D1-unspliced" else s[acceptor])
    return s[stage] + s[acceptor]


def steps() -> list[tuple[str, int, str, str]]:
    """(stage, ord, acceptor, pattern)."""
    return [(stage, i, a, pattern(stage, a)) for stage, names in STAGES.items() for i, a in enumerate(names.split())]


def one_edit(s: str, p: str) -> str:
    """Where the best match of an expression p within one edit begins in s, from 1, or NULL.

    Least distance, then first end; of equal pieces there the one as long as p, then
    the longer.  Only ends near an unchanged half of p are looked at.
    """
    m = f"length({p})"
    a, b = f"left({p}, {m} // 2)", f"substr({p}, {m} // 2 + 1)"
    around = f"substr({s}, CAST(greatest(z - {m} - 1, 0) + 1 AS BIGINT), {m} + 2)"
    score = lambda n, rank: f"CASE WHEN z >= {n} THEN levenshtein(substr({s}, CAST(z - {n} + 1 AS BIGINT), CAST({n} AS BIGINT)), {p}) * 1000000 + z * 10 + {rank} END"
    lo = f"least(nullif(strpos({s}, {a}), 0), nullif(strpos({s}, {b}), 0))"
    hi = f"length({s}) - least(nullif(strpos(reverse({s}), reverse({a})), 0), nullif(strpos(reverse({s}), reverse({b})), 0)) + 1"  # where the last half ends
    ends = f"list_filter(range({lo}, least(length({s}), {hi} + {m}) + 1), lambda z: contains({around}, {a}) OR contains({around}, {b}))"
    best = f"list_min(list_transform({ends}, lambda z: least({score(m, 0)}, {score(f'({m} + 1)', 1)}, {score(f'({m} - 1)', 2)})))"
    begin = f"list_transform([{best}], lambda y: CASE WHEN y < 2000000 THEN y % 1000000 // 10 - (CASE y % 10 WHEN 0 THEN {m} WHEN 1 THEN {m} + 1 ELSE {m} - 1 END) + 1 END)[1]"
    return f"CASE WHEN contains({s}, {p}) THEN strpos({s}, {p}) WHEN contains({s}, {a}) OR contains({s}, {b}) THEN {begin} END"


def _first(candidates: list[tuple[str, str]], edits: int) -> str:
    """The first of (name, pattern) that occurs in s, as a struct of name and pattern, or place if edits are allowed; or NULL."""
    if edits:
        return "list_filter([" + ", ".join(f"{{'a': '{a}', 'p': {one_edit('s', repr(p))}}}" for a, p in candidates) + "], lambda x: x.p IS NOT NULL)[1]"
    return "list_filter([" + ", ".join(f"{{'a': '{a}', 'p': '{p}'}}" for a, p in candidates) + "], lambda x: contains(s, x.p))[1]"


def overlapped(reads: str) -> str:
    """read_ix, id, umi, s (what is searched) and joined, of (read_ix, id, r1, r2)."""
    return f"""(SELECT read_ix, id, umi, CASE WHEN o IS NOT NULL THEN a || substr(b, CAST(o AS BIGINT) + 1) END AS joined, CASE WHEN o IS NOT NULL THEN a || substr(b, CAST(o AS BIGINT) + 1) ELSE a || b END AS s
      FROM (SELECT *, list_max(list_filter(range(10, least(length(a), length(b)) + 1), lambda n: hamming(right(a, n), left(b, n)) <= n * 0.02)) AS o
            FROM (SELECT read_ix, id, substr(r2, 1, 14) AS umi, substr(r1, 5) AS a, reverse(translate(substr(r2, 15), 'ACGT', 'TGCA')) AS b FROM ({reads}) r
                  WHERE NOT regexp_matches(r1, '{_RUNS}') AND NOT regexp_matches(r2, '{_RUNS}')) p) q)"""


_RUNS = "|".join(f"[^{b}]{b}{{11,}}[^{b}]" for b in "ACGTN")


def chains(searched: str, edits: int = 0) -> str:
    """A WITH RECURSIVE list that ends in ``chain``: read_ix, chain (list), tail, alt, beyond."""
    d1 = len(SITES["D1"])
    of = lambda stage: _first([(a, pattern(stage, a)) for a in STAGES[stage].split()], edits)
    site = lambda name: _first([(name, SITES[name])], edits)
    looked = {1: site("D1"), 2: of("D1"), 3: site("D2"), 4: of("D2"), 5: site("D3"), 6: site("D2b"), 7: of("D3"), 8: of("alternative D1"), 9: of("D1prime"), 10: of("D2b")}
    hit = "CASE stage " + " ".join(f"WHEN {k} THEN {x}" for k, x in looked.items()) + " END"
    return f"""m AS (
  SELECT read_ix, s, 1 AS stage, CAST([] AS VARCHAR[]) AS chain, CAST(NULL AS VARCHAR) AS alt, CAST(NULL AS VARCHAR) AS beyond FROM {searched} t
  UNION ALL
  SELECT read_ix, CASE WHEN hit IS NULL THEN s ELSE substr(s, place) END AS s,
    CASE WHEN hit IS NULL THEN CASE WHEN stage = 1 THEN 8 WHEN stage = 2 THEN 9 WHEN stage = 9 AND length(s) > {d1 + 4} THEN 8 ELSE 0 END
         WHEN stage = 1 THEN 2 WHEN stage = 3 THEN 4 WHEN stage = 5 THEN 7 WHEN stage = 6 THEN 10
         WHEN stage = 4 AND hit.a = 'D2-unspliced' THEN 6 WHEN hit.a = 'A1' AND stage IN (2, 8, 9) THEN 3 WHEN hit.a = 'A2' THEN 5 ELSE 0 END AS stage,
    CASE WHEN hit IS NULL THEN list_concat(chain, CASE stage WHEN 1 THEN ['noD1'] WHEN 3 THEN ['noD2'] WHEN 5 THEN ['noD3'] WHEN 6 THEN ['noD2b'] WHEN 8 THEN ['no-acceptor'] WHEN 9 THEN CAST([] AS VARCHAR[]) ELSE ['unknown'] END)
         WHEN stage = 9 THEN ['D1prime', hit.a]
         WHEN stage = 8 AND hit.a = 'gag-AUG' THEN list_concat(chain, ['gag-AUG', 'unspliced'])
         ELSE list_append(chain, hit.a) END AS chain,
    CASE WHEN stage = 8 AND hit IS NOT NULL THEN right(left(s, place - 1), 15) ELSE alt END AS alt,
    CASE WHEN hit IS NULL AND stage = 2 THEN substr(s, {d1 + 1}, 15) WHEN hit IS NULL AND stage = 9 AND length(s) > {d1 + 4} THEN substr(s, {d1 + 5}, 15) ELSE beyond END AS beyond
  FROM (SELECT *, {'hit.p' if edits else 'strpos(s, hit.p)'} AS place FROM (SELECT *, {hit} AS hit FROM m WHERE stage > 0) h) w
), chain AS (SELECT read_ix, chain, s AS tail, alt, beyond FROM m WHERE stage = 0)"""


def size_class(chain: str, tail: str, genome: str, assay: str = "'random-reverse'", edits: int = 0) -> str:
    """Size class of a chain (a list) and its tail; places in the genome count from 0."""
    first = f"list_filter({chain}, lambda e: e IN ('A7', 'unknown', 'no-acceptor', 'D1-unspliced', 'gag-AUG'))[1]"
    ends = f"range(length({tail}) - 15, 9, -20)"
    piece = f"substr({tail}, CAST(greatest(e - 20, 0) + 1 AS BIGINT), CAST(least(e, 20) AS BIGINT))"
    at = lambda p: f"coalesce({one_edit(genome, p)}, 0)" if edits else f"strpos({genome}, {p})"
    places = f"list_filter(list_transform(list_slice({ends}, 1, 10), lambda e: {at(piece)} - 1), lambda p: p >= 0)"
    one = f"{at(f'left(right({tail}, 30), 15)')} - 1"
    some = lambda test: f"len(list_filter({places}, lambda p: {test})) > 0"
    return f"""CASE WHEN {first} = 'A7' THEN '1.8kb' WHEN {first} IN ('unknown', 'no-acceptor') THEN 'Unknown' WHEN {first} IS NOT NULL THEN 'Unspliced'
    WHEN {assay} <> 'random-reverse' THEN CASE WHEN length({tail}) < 30 OR {one} < 0 THEN 'Unknown' WHEN {one} > {A7} THEN '1.8kb' WHEN {assay} = 'k-mer' OR {one} < {D4} THEN '4kb' ELSE 'Unknown' END
    WHEN {some(f'p > {D4} AND p < {A7}')} THEN '4kb' WHEN {some(f'p > {A7}')} THEN '1.8kb' WHEN {some(f'p < {D4}')} THEN 'Both' ELSE 'Unknown' END"""
