import itertools
import random

import pytest
from pyspark.sql import functions as F

from spliceloom.config import Assay, RunConfig, build_config, strain_sites
from spliceloom.functions import fuzzy, seq, stats
from spliceloom.operators import chain, isoforms, umi
from spliceloom.plans import mock

GENOME = mock.pseudo_genome()


def brute_find(text, pattern, k):
    """(end, distance) by full dynamic programming."""
    m = len(pattern)
    col, best, end = list(range(m + 1)), m, 0
    for j, c in enumerate(text):
        new = [0]
        for i in range(1, m + 1):
            new.append(min(col[i - 1] + (pattern[i - 1] != c), col[i] + 1, new[i - 1] + 1))
        col = new
        if col[m] < best:
            best, end = col[m], j + 1
    return (end, best) if best <= k else None


def test_find_many_equals_find():
    """Texts with edited copies of the pattern, some twice, some cut off, more and fewer than a batch of lanes."""
    rng = random.Random(8)

    def edited(p, edits):
        out = list(p)
        for _ in range(edits):
            i = rng.randrange(len(out))
            out[i] = rng.choice(["", rng.choice("ACGT"), out[i] + rng.choice("ACGT")])
        return "".join(out)

    some = lambda n, letters: "".join(rng.choices(letters, k=n))
    found = 0
    for size, letters, k in [(8, "AC", 1), (9, "ACGT", 2), (16, "ACGT", 1), (27, "AC", 3), (40, "ACGT", 2), (5, "ACGT", 1)]:
        p = some(size, letters)
        texts = [(some(rng.randrange(60), letters) + edited(p, rng.randrange(5)) + some(rng.randrange(60), letters) + rng.choice(["", edited(p, 2)])).encode() for _ in range(1500)] + [b"", b"A", p.encode()]
        for part in (texts, texts[:3], []):
            want = [fuzzy.find(t, p.encode(), k) for t in part]
            assert fuzzy.find_many(part, p.encode(), k) == want
            found += sum(x is not None for x in want)
    assert found > 3000


def test_index_equals_find():
    rng = random.Random(10)
    text = ("".join(rng.choices("ACGT", k=3000)) + "A" * 60 + "ACACAC" * 20).encode()
    index, found = fuzzy.Index(text), 0
    for _ in range(1500):
        at, size = rng.randrange(len(text)), rng.randrange(1, 40)
        piece = bytearray(text[at : at + size])
        for _ in range(rng.randrange(3)):
            if piece:
                i = rng.randrange(len(piece))
                piece[i : i + rng.randrange(2)] = rng.choice([b"", b"A", b"GT"])
        for k in (0, 1, 2):
            want = fuzzy.find(text, bytes(piece), k)
            assert index.find(bytes(piece), k) == want, (piece, k)
            found += want is not None
    assert found > 2000
    assert fuzzy.Index(b"").find(b"ACGTACGTAC", 1) is None and index.find(b"", 1) == (0, 0, 0)


def test_read_many_equals_read():
    rng = random.Random(9)
    c = build_config(distance=1, genome=GENOME)
    texts = []
    for form in ("D1 A1 D2 D2-unspliced D2b A2 D3 A7", "D1 A2 D3 A3", "D1 gag-AUG", "A1 D2 A5a", "D1", "", "A7"):
        for _ in range(30):
            s = list("".join("CTATCTCATACTCATCATAC"[: rng.randrange(20)] * (e in ("D2", "D3", "D2b")) + c.sites[e] for e in form.split()) + "".join(rng.choices("ACGT", k=60)))
            for _ in range(rng.randrange(3)):
                s[rng.randrange(len(s))] = rng.choice("ACGT")
            texts.append("".join(s).encode())
    r = chain.Reader(c)
    assert r.read_many(texts) == [r.read(t) for t in texts] and len({tuple(x[0]) for x in r.read_many(texts)}) > 8


def test_find_equals_full_alignment():
    rng = random.Random(0)
    for _ in range(3000):
        text = "".join(rng.choice("ACG") for _ in range(rng.randint(0, 60))).encode()
        pattern = "".join(rng.choice("ACG") for _ in range(rng.randint(1, 12))).encode()
        k = rng.randint(0, 4)
        got, want = fuzzy.find(text, pattern, k), brute_find(text, pattern, k)
        assert (got and (got[1], got[2])) == want, (text, pattern, k)
        if got:
            # the traced start gives the same distance when the pattern is aligned to that piece whole
            piece = text[got[0] : got[1]]
            d = list(range(len(piece) + 1))
            for i, p in enumerate(pattern):
                row = [i + 1]
                for j, c in enumerate(piece):
                    row.append(min(d[j] + (p != c), d[j + 1] + 1, row[j] + 1))
                d = row
            assert d[-1] == got[2]


def test_overlaps_equal_a_plain_loop():
    rng = random.Random(1)
    pairs = []
    for _ in range(200):
        base = "".join(rng.choice("ACGT") for _ in range(rng.randint(20, 150))).encode()
        cut = rng.randint(0, len(base))
        other = bytearray(base[cut:] + b"ACGTTGCA"[: rng.randint(0, 8)])
        for _ in range(rng.randint(0, 2)):
            if other:
                other[rng.randrange(len(other))] = rng.choice(b"ACGT")
        pairs.append((base, bytes(other)))
    want = [next((o for o in range(min(len(a), len(b)), 9, -1) if sum(x != y for x, y in zip(a[len(a) - o :], b)) <= o * 0.02), None) for a, b in pairs]
    assert fuzzy.overlaps([a for a, _ in pairs], [b for _, b in pairs]) == want
    assert any(want) and None in want


def test_sequence_columns(spark):
    df = spark.createDataFrame([("ACGTTTTT",), ("aaccggtt",), ("ARWN",), ("AGGTACCA",)], "s string")
    got = [r[0] for r in df.select(seq.reverse_complement(F.col("s"))).collect()]
    assert got == ["AAAAACGT", "aaccggtt", "NWYT", "TGGTACCT"]
    long = spark.createDataFrame([("AAACCCCTTTTTTTTTTTTGGG", True), ("AAACCCCTTTTGGG", False), ("AAACCCCTTTTTTTTTTTT", False), ("AAAAAAAAAAAACCCCTTTT", False)], "s string, w boolean")
    assert all(r[0] == r[1] for r in long.select(seq.has_homopolymer(F.col("s")), "w").collect())
    cases = [("ACGTACGT", "ACGN", 0, True), ("AGCTACGT", "ARCN", 0, True), ("ACGTACGT", "ACAT", 1, True), ("ACGTACGT", "ACAT", 0, False), ("ACG", "ACGT", 0, False), ("acgt", "ACGT", 0, True), ("AXGT", "ANGT", 0, False)]
    for s, p, k, want in cases:
        assert spark.createDataFrame([(s,)], "s string").select(seq.header_matches(F.col("s"), p, k)).first()[0] == want, (s, p, k)
    assert seq.is_iupac("ARYN") and seq.is_iupac("acgu") and not seq.is_iupac("ACGX") and not seq.is_iupac("")
    with pytest.raises(ValueError):
        seq.header_matches(F.lit("A"), "ACGX", 0)


def test_slices(spark):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    assert chain.slices(letters.encode(), 10, 15, 5) == [b"BCDEFGHIJK"]
    for s in (letters, letters[:15], letters[:14], "", letters * 4, "x" * 45, "y" * 25):
        row = spark.createDataFrame([(s,)], "s string").select(seq.slices_from_end(F.col("s")), seq.slices_from_end(F.col("s"), 10, 15, 5)).first()
        assert row[0] == [x.decode() for x in chain.slices(s.encode())]
        assert row[1] == [x.decode() for x in chain.slices(s.encode(), 10, 15, 5)]


def test_steps():
    c = build_config()
    assert c.d1_to_all[0].pattern == "GGGGCGGCGACTGGTGAGTACGCC"
    assert c.d2_to_all[0].pattern == "CTCTGGAAAGGTGAAGGGGC" and c.d2_to_all[1].pattern == "CTCTGGAAAGAATCTGCTATAAGAAA"
    assert (c.alternative_d1_to_all[0].acceptor, c.alternative_d1_to_all[0].pattern) == ("A1", "GGACAGCAGAGATCCA")
    assert (c.alternative_d1_to_all[-1].acceptor, c.alternative_d1_to_all[-1].pattern) == ("gag-AUG", "GAGAGATGGGTGC")
    assert c.d1prime_to_all[0].pattern == c.d1_to_all[0].pattern and len(c.d3_to_all[1].pattern) == 16
    with pytest.raises(ValueError):
        strain_sites("none")
    for bad in ({"min_fraction": 1.5}, {"neighbor_risk": -1}, {"header": "QQ"}, {"distance": -1}):
        with pytest.raises(ValueError):
            RunConfig(**bad)
    assert RunConfig(assay="k-mer").stem == "output_strain_nl43_distance_1_assay_kmer"


@pytest.mark.parametrize("assay,want", [("size-specific", ["4kb", "1.8kb", "Unknown", "1.8kb"]), ("k-mer", ["4kb", "1.8kb", "4kb", "1.8kb"]), ("random-reverse", ["Both", "1.8kb", "4kb", "4kb"])])
def test_size_classes(assay, want):
    r = chain.Reader(build_config(assay=assay, distance=2, genome=GENOME))
    tails = [GENOME[a:b].encode() for a, b in ((5100, 5160), (8000, 8060), (7000, 7060), (7580, 7700))]
    assert [r.size_class(["D1", "A1"], t) for t in tails] == want
    assert r.size_class(["D1", "A1"], b"") == "Unknown" and r.size_class(["D1", "A7"], b"") == "1.8kb"
    assert r.size_class(["D1", "unknown", "A7"], b"") == "Unknown" and r.size_class(["D1", "D1-unspliced"], b"") == "Unspliced"


@pytest.mark.parametrize("k", [0, 1])
def test_mock_chains_are_read_back(spark, k):
    forms = [f for f in isoforms.mock_ratios() if f != "D1_unknown"]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "ix long, form string")
    reads = mock.reads(rows, "form", "ix", GENOME)
    got = {r.read_ix: r for r in chain.events(reads, build_config(distance=k, genome=GENOME)).collect()}
    assert len(got) == len(forms)
    wrong = [(f, got[i].splice_category) for i, f in enumerate(forms) if f != "noD1" and got[i].splice_category != f]
    assert len(wrong) <= k, wrong
    assert got[forms.index("noD1")].splice_category == "noD1_no-acceptor"
    for i, f in enumerate(forms):
        e = got[i]
        assert e.final_category == f"{e.splice_category}_{e.size_class}"
        if not any(x in f for x in ("A7", "unspliced", "unknown", "noD1")) or "D2-unspliced_D2b_A" in f and "A7" not in f and "unknown" not in f:
            assert e.size_class == e.sequence_id.split("_")[-2], (f, e.size_class)


def test_chain_stages():
    c = build_config(distance=0, genome=GENOME)
    r = chain.Reader(c)
    s = c.sites
    x = b"CTATCTCATACTC"
    read = lambda *parts: r.read(b"".join(p.encode() if isinstance(p, str) else p for p in parts))
    assert read(x, s["D1"], s["gag-AUG"])[0] == ["D1", "unknown", "gag-AUG", "unspliced"] or read(x, s["D1"], s["gag-AUG"])[0] == ["D1", "gag-AUG"]
    assert read(x, x, s["A1"])[0] == ["noD1", "A1", "noD2"] and read(x, x, s["A1"])[2] == (x + x)[-15:]
    got = read(s["D1"], s["D1-unspliced"][:4], s["A3"], x)
    assert got[0] == ["D1prime", "A3"] and got[3] == (s["D1-unspliced"][:4] + s["A3"])[:15].encode()
    got = read(s["D1"], x * 3)
    assert got[0] == ["D1", "unknown", "no-acceptor"] and got[3] == (x * 3)[4:19]
    assert read(s["D1"])[0] == ["D1", "unknown"] and read(s["D1"])[3] == b""
    assert read(x, s["gag-AUG"])[0] == ["noD1", "gag-AUG", "unspliced"]
    assert read(s["D1"], s["A2"], x, s["D3"], s["A4a"])[0] == ["D1", "A2", "D3", "A4a"]
    assert read(s["D1"], s["A1"], x, s["D2"], s["D2-unspliced"], x, s["D2b"], s["A2"], x, s["D3"], s["D3-unspliced"])[0] == ["D1", "A1", "D2", "D2-unspliced", "D2b", "A2", "D3", "D3-unspliced"]
    assert read(s["D1"], s["A1"], x, s["D2"], s["D2-unspliced"], x)[0][-1] == "noD2b"
    assert read(b"")[0] == ["noD1", "no-acceptor"]


def umi_table(spark, counts, cat="c"):
    return spark.createDataFrame([(cat, u, n) for u, n in counts], "final_category string, umi string, n long")


def families_of(df):
    return {r.umi: r.umi_family for r in df.collect()}


def test_cutoff(spark):
    df = spark.createDataFrame([(9,), (100,), (400,), (1000,), (5000,), (220_553,)], "m long")
    assert [r[0] for r in df.select(stats.cutoff(F.col("m"))).collect()] == [2, 3, 4, 6, 18, 2]


@pytest.mark.parametrize("limit", [20_000, 0])
def test_clusters(spark, limit):
    run = lambda c, d, f: families_of(umi.cluster(umi_table(spark, c), d, f, limit))
    assert run([("AAAAA", 3), ("AAAAT", 2), ("AAATT", 1), ("GGGGG", 1), ("AAAA", 1)], 1, 0.25) == {"AAAAA": "AAAAA", "AAAAT": "AAAAA"}
    assert run([("AAAAA", 3), ("AAAAT", 2), ("AAATT", 2)], 1, 0.0)["AAATT"] == "AAATT"
    assert set(run([("AAAAT", 2), ("AAAAA", 2)], 1, 0.0).values()) == {"AAAAA"}
    assert run([("AAAAA", 3), ("AAATT", 2)], 2, 0.5)["AAATT"] == "AAAAA"
    assert run([("ACG", 2), ("TTT", 1)], 3, 0.0) == {"ACG": "ACG", "TTT": "ACG"}


def sequential(counts, d):
    order = sorted(counts, key=lambda x: (-x[1], x[0]))
    family = {}
    for p, _ in order:
        if p in family:
            continue
        family[p] = p
        for u, _ in order:
            if u not in family and len(u) == len(p) and sum(a != b for a, b in zip(u, p)) <= d:
                family[u] = p
    return family


def test_both_cluster_paths_equal_the_sequential_order(spark):
    rng = random.Random(4)
    for d in (0, 1, 2):
        pool = {"".join(rng.choice("AC") for _ in range(rng.choice((6, 7)))): rng.randint(1, 4) for _ in range(60)}
        want = sequential(list(pool.items()), d)
        for limit in (20_000, 0):
            assert families_of(umi.cluster(umi_table(spark, pool.items()), d, 0.0, limit)) == want


def test_family_golden_counts(spark):
    rows = [("c", u) for u, n in (("AAAAA", 1000), ("TTTTT", 50), ("CCCCC", 5), ("GGGGG", 500)) for _ in range(n)]
    events = spark.createDataFrame(rows, "final_category string, umi string")
    got = umi.families(events, "max-model").groupBy("umi", "umi_family", "umi_family_size", "umi_family_fraction", "umi_unique_count", "umi_unique_fraction", "umi_neighbor_risk").count().collect()
    by = {r.umi: r for r in got}
    assert by["CCCCC"].umi_family is None and by["CCCCC"]["count"] == 5
    assert by["AAAAA"].umi_family_size == 1000 and by["AAAAA"].umi_family_fraction == 1000 / 1555
    assert by["AAAAA"].umi_unique_count == 4 and by["AAAAA"].umi_unique_fraction == 4 / 1555 and by["AAAAA"].umi_neighbor_risk is None
    tied = spark.createDataFrame([("c", u) for u in ("AA", "CC", "GG", "TT") for _ in range(2)], "final_category string, umi string")
    assert umi.families(tied, "max-model").where("umi_family is not null").isEmpty()


def test_automatic_choice(spark):
    def used(umis, d=1, **more):
        df = spark.createDataFrame([("c", u) for u in umis], "final_category string, umi string")
        r = umi.decisions(umi.counts(df), "auto-model", d, **more).first()
        return r.umi_model_used, r.umi_neighbor_risk

    assert used(["ACGTACGTACGTAC"] * 10) == ("max-model", 0.0)
    assert used(["ACGTACGTACGTAC"] + ["".join(p) for p in itertools.islice(itertools.product("AC", repeat=14), 5)])[0] == "cluster-model"
    six = ["".join(p) for p in itertools.islice(itertools.product("ACGT", repeat=6), 20)]
    got = used(six, 2)
    assert got[0] == "max-model" and got[1] == pytest.approx(0.70989, abs=1e-5)
    assert used(six, 2, risk_limit=0.8)[0] == "cluster-model"
    assert used(["ACGN", "ACGT"]) == ("max-model", None)


def test_packed_mismatches(spark):
    rng = random.Random(9)
    rows = [("".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("ACGT") for _ in range(n)), n) for n in (1, 5, 14, 15, 16) for _ in range(20)]
    for n in (1, 5, 14, 15, 16):
        mine = [r for r in rows if r[2] == n]
        df = spark.createDataFrame(mine, "a string, b string, n int")
        got = df.select("a", "b", seq.mismatches(seq.packed(F.col("a"), n), seq.packed(F.col("b"), n), n).alias("d")).collect()
        assert all(r.d == sum(x != y for x, y in zip(r.a, r.b)) for r in got)


def test_simulation(spark):
    assert mock.simulated_umis(spark.range(10_000), 14, 100).agg(F.sum("n")).first()[0] == 10_000
    with pytest.raises(ValueError):
        mock.simulated_umis(spark.range(10), 2, 17)
    assert Assay("k-mer").in_file_names == "kmer"


# ---- fixed values: a pair of reads that overlap, what they join to, and where patterns match in it
R1 = b"NNNNTTAGTAGAAATTTGTACAGAGATGGAAAAGGAAGGGAAAATTTCAAAAATTGGGCCTGAAAATCCATACAATACTCCAGTATTTGCCATAAAGAAAAAAGA"
R2 = b"NNNNNNNNNNNNNNAAATCTACTAATTTTCTCCATTTAGTACTGTCTTTTTTCTTTATGGCAAATACTGGAGTATTGTATGGATTTTCAGGCCCAATTTTTGAAATTTTCCCTTC"
JOINED = b"TTAGTAGAAATTTGTACAGAGATGGAAAAGGAAGGGAAAATTTCAAAAATTGGGCCTGAAAATCCATACAATACTCCAGTATTTGCCATAAAGAAAAAAGACAGTACTAAATGGAGAAAATTAGTAGATTT"
# ---- end of fixed values


def test_golden_join_and_search():
    a, rc = R1[4:], fuzzy.revcomp(R2[14:])
    (o,) = fuzzy.overlaps([a], [rc])
    assert fuzzy.join_pair(a, rc, o) == JOINED
    assert fuzzy.find(JOINED, b"AGAGCTGGAAAGGAAGGGAAA", 2) == (17, 39, 2)
    assert fuzzy.find(JOINED, b"AGAGCTGGAAACGAAGGGAAA", 2) is None
    start, _, _ = fuzzy.find(JOINED, b"AGAGATGGAAAAGGAAGGGAAA", 2)
    assert JOINED[max(0, start - 15) : start] == b"AGTAGAAATTTGTAC"


def test_long_umis_cluster_alike_in_both_paths(spark):
    base = "ACGTTGCAAC" * 6
    rows = []
    for size in (40, 41, 60):
        u = base[:size]
        rows += [(str(size), u, 9), (str(size), "G" + u[1:], 2), (str(size), u[:-2] + "TT", 1), (str(size), "TTTTT" + u[5:], 4)]
    df = spark.createDataFrame(rows, "final_category string, umi string, n long")
    small, large = ({tuple(r) for r in umi.cluster(df, 2, 0.0, t).collect()} for t in (20_000, 0))
    assert small == large and len({x[2] for x in small}) == 6


def test_decisions_for_any_length(spark):
    """Neighbour risk without a table of lengths, and no crash beyond one."""
    from math import comb

    for length in (3, 14, 41, 60):
        for d in (1, 2, 5):
            n = 50
            got = spark.range(1).select(stats.neighbour_risk(F.lit(n), F.lit(length), d).alias("r")).first().r
            want = n - 1 if length <= d else (n - 1) * sum(comb(length, k) * 3**k for k in range(1, d + 1)) / (4.0**length - 1)
            assert got == pytest.approx(want, rel=1e-12), (length, d)
    rows = [("c", "ACGT" * 15, 3), ("c", "ACGT" * 14 + "AAAA", 1)]
    got = umi.decisions(spark.createDataFrame(rows, "final_category string, umi string, n long"), "auto-model", 1).first()
    assert got.umi_model_used == "cluster-model" and got.umi_neighbor_risk > 0


def test_clustering_runs_once(spark):
    df = umi_table(spark, [("AAAAA", 3), ("AAAAT", 2), ("GGGGG", 1)])
    events = df.selectExpr("final_category", "umi", "explode(sequence(1, cast(n as int))) as k")
    for model in ("auto-model", "cluster-model"):
        plan = umi.families(events, model)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("FlatMapGroupsInPandas") == 0  # it ran already, once, before the cut


def test_chunks_of_any_length(spark):
    """Pairs within a distance against all pairs, lengths mixed."""
    rng = random.Random(6)
    for d in (0, 1, 3, 7):
        pool = list({"".join(rng.choice("AC") for _ in range(rng.choice((1, 2, 5, 9, 44)))) for _ in range(40)})
        near = pool + ["G" + u[1:] for u in pool[:10]]
        df = spark.createDataFrame([("c", u, 1) for u in set(near)], "final_category string, umi string, n long")
        got = {(r.a, r.b) for r in umi.hamming_pairs(df, d).collect()}
        want = {(a, b) for a in set(near) for b in set(near) if a < b and len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= d}
        assert got == want
