"""What keeps a job's work in proportion to its input: how rows are dealt out, how often a step runs, what is stored."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.functions import seq
from spliceloom.operators import chain, umi
from spliceloom.plans import driver

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(driver, "TASK_ROWS", 100)
    rows = driver.load(spark, SF, "orders").select("o_orderkey")
    few, many = (driver.spread(df).rdd.getNumPartitions() for df in (rows.limit(300), rows))
    assert few == spark.sparkContext.defaultParallelism < many == -(-rows.count() // 100)


@pytest.mark.parametrize("name", ["joined_records", "joined_records_exact"])
def test_a_filter_on_joined_reads_runs_the_search_once_where_rows_are_spread(spark, monkeypatch, name):
    monkeypatch.setattr(driver, "TASK_ROWS", 100)
    df = driver.QUERIES[name](spark, SF)
    assert plan(df).count("ArrowEvalPython") == 1 and df.rdd.getNumPartitions() > 8


def test_reads_are_filtered_where_rows_are_spread(spark):
    """Below the exchange that spreads them a filter would run in as few tasks as the file has row groups."""
    assert "Exchange" not in plan(driver.splice_events_exact(spark, SF))


def test_homopolymers_of_reads_without_long_runs_need_no_pattern(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ACGTN") * rng.choice([1, 1, 2, 9, 10, 11, 12, 30]) for _ in range(rng.randrange(6))) for _ in range(500)] + [None, "", "A" * 11, "CAAAAAAAAAAAC"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(seq.has_homopolymer(F.col("s")).alias("x"), F.col("s").rlike(seq.homopolymer_pattern()).alias("y")).collect()
    assert all(r.x == r.y for r in got) and len({r.x for r in got}) == 3
    assert "contains" in plan(df.select(seq.has_homopolymer(F.col("s")))).lower()


def test_exact_overlap_of_repeats(spark):
    """Against a plain loop, where the first bases of the second read occur many times or overlap themselves."""
    rng = random.Random(9)
    rows = [("".join(rng.choices(al, k=rng.randrange(60))), "".join(rng.choices(al, k=rng.randrange(60)))) for al in ("A", "AC", "ACGT") for _ in range(150)]
    rows += [(a + s, s + b) for a, b in rows[:300] for s in ["ACGTTGCA" * rng.randrange(1, 5) + a[:9]]]
    df = spark.createDataFrame(rows, "a string, b string")
    for least in (3, 10):
        got = [r.o for r in df.select(seq.exact_overlap(F.col("a"), F.col("b"), least).alias("o")).collect()]
        assert got == [max((o for o in range(least, min(len(a), len(b)) + 1) if a.endswith(b[:o])), default=None) for a, b in rows]
    filters = plan(df.select(seq.exact_overlap(F.col("a"), F.col("b")))).split("sequence(")[0]
    assert "position(" in filters or "locate(" in filters  # all sizes are only looked at where the first place is none


def test_copies_of_a_pair_are_read_once(spark, monkeypatch):
    from spliceloom.config import build_config

    seen = []
    read = chain.Reader.read_many
    monkeypatch.setattr(chain.Reader, "read_many", lambda self, texts: seen.append(len(texts)) or read(self, texts))
    run = chain.splice_chain(build_config(distance=0, genome=driver.GENOME)).func
    import pandas as pd

    rows = run(pd.Series(["ACGT" * 20, "GGCA" * 20] * 50), pd.Series(["TTGACCA" * 9] * 100))
    assert len(rows) == 100 and sum(seen) == 2 and rows.iloc[0].astype(str).equals(rows.iloc[98].astype(str))


@pytest.mark.parametrize("task_umis", [0, 20_000])
def test_clustering_reads_its_input_once(spark, task_umis):
    """Rows that a source gives are counted by an accumulator."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    umis = spark.createDataFrame([("c", u, n) for u, n in (("ACGT", 9), ("ACGA", 2), ("TTTT", 5), ("TTTA", 5))], "final_category string, umi string, n bigint")
    got = umi.cluster(umis.mapInArrow(seen, umis.schema), 1, 0.0, task_umis=task_umis)
    assert {(r.umi, r.umi_family) for r in got.collect()} == {("ACGT", "ACGT"), ("ACGA", "ACGT"), ("TTTA", "TTTA"), ("TTTT", "TTTA")}
    assert read.value == 4


def test_a_task_of_the_source_is_sent_its_own_range_only():
    import json
    import pickle

    from spliceloom.sources import reads

    def sent(reader, option, item, n):
        return len(pickle.dumps(reader({option: json.dumps([item] * n)})))

    for reader, option, item in ((reads._Counter, "ranges", ["/a", "fasta", False, 0, 1]), (reads._Reader, "tasks", [0, "fasta", [False, False], 0, 1, []])):
        assert sent(reader, option, item, 1) == sent(reader, option, item, 1000)


def test_files_of_ordered_pairs_take_one_pass_and_parts_grow_with_the_rows(spark, monkeypatch, tmp_path):
    from spliceloom.sources import reads, writer

    monkeypatch.setattr(writer, "PART_ROWS", 50)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(1000).selectExpr("id AS read_ix", "concat('r', id) AS id", "repeat('ACGT', cast(id % 7 AS int)) AS r1", "concat('TTG', id % 2) AS r2")
    assert writer.in_order(rows, "read_ix").rdd.getNumPartitions() == 20
    pair = [str(tmp_path / f"r{i}.fastq.gz") for i in (1, 2)]
    writer.write_pairs(writer.in_order(rows, "read_ix").mapInArrow(seen, rows.schema), *pair, ordered=True)
    assert read.value == 1000
    got = reads.read_pairs(spark, *pair).orderBy("read_ix").select("read_ix", "id", "r1", "r2").collect()
    assert [(r.read_ix, r.id, r.r1, r.r2) for r in got] == [(r.read_ix, f"{r.id}_r1", r.r1, r.r2) for r in rows.orderBy("read_ix").collect()]


@pytest.mark.parametrize("sent", [0, 100_000])
def test_few_families_are_sent_to_the_reads(spark, monkeypatch, sent):
    monkeypatch.setattr(umi, "SENT_ROWS", sent)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what Spark itself takes for small
    try:
        df = driver.per_read_families_exact(spark, SF)
        shown = plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in shown, "Exchange hashpartitioning" in shown) == (sent > 0, sent == 0)
    assert df.count() == driver.load(spark, SF, "orders").count()


def test_the_native_size_class_does_not_read_the_genome(spark):
    """A piece is looked up in a table, and the first of its places counts."""
    from spliceloom.config import build_config
    from spliceloom.operators import chain_native

    rng = random.Random(2)
    genome = driver.GENOME[:4000] + driver.GENOME[100:140] + driver.GENOME[4000:]
    config = build_config(distance=0, genome=genome)
    tails = [genome[at : at + n] + "".join(rng.choices("ACGT", k=rng.choice([15, 15, 16]))) for at in (0, 3, 100, 110, 4000, 5000, 8000, len(genome) - 30) for n in (10, 12, 20, 25, 40)]
    df = spark.createDataFrame([(t,) for t in tails], "tail string")
    size = chain_native.size_class(F.array(F.lit("A5")), F.col("tail"), config)
    assert [r.x for r in df.select(size.alias("x")).collect()] == [chain.Reader(config).size_class(["A5"], t.encode()) for t in tails]
    assert genome not in plan(df.select(size))


def test_windows_and_tails_seen_before_are_not_aligned_or_located_again(monkeypatch):
    """Reads of one isoform share them: work grows with what differs."""
    from spliceloom.config import build_config
    from spliceloom.functions import fuzzy

    rng = random.Random(4)
    pattern = b"ACGTTGCAGGTCATTCGACC"
    one = [b"GG" + pattern[:i] + b"A" + pattern[i + 1 :] + b"GG" for i in range(20)]
    texts = one + [b"".join(rng.choices([b"A", b"C", b"G", b"T"], k=30)) + t for t in one] + one
    want = [fuzzy.find(t, pattern, 1) for t in texts]
    aligned = []
    lanes = fuzzy._align_many
    monkeypatch.setattr(fuzzy, "_align_many", lambda windows, p, k: aligned.append(len(windows)) or lanes(windows, p, k))
    assert [fuzzy.find_many(texts, pattern, 1) for _ in range(3)] == [want] * 3 and len(aligned) == 1
    sizes = []
    size = chain.Reader.size_class
    monkeypatch.setattr(chain.Reader, "size_class", lambda self, c, t: sizes.append(t) or size(self, c, t))
    reader = chain.Reader(build_config(genome=driver.GENOME))
    reads = ["ACGT"[i % 4] * 3 + reader.c.d1_to_all[-1].pattern + driver.GENOME[7000:7100] for i in range(8)]
    found = [r[-1] for r in chain._read_pairs(reader, [(r, "ACCA" * 9) for r in reads])]
    assert len(found) == 8 and len(set(found)) == len(sizes) == 1


def test_all_texts_are_searched_as_one():
    """Places at the ends of texts, occurrences that overlap, empty texts."""
    from spliceloom.functions import fuzzy

    texts = [b"", b"AAAA", b"CAA", b"", b"AAC", b"A", b""]
    assert list(fuzzy._occurrences(texts, b"AA")) == [(1, 0), (1, 1), (1, 2), (2, 1), (4, 0)]
    assert list(fuzzy._occurrences([], b"AA")) == []
    rng = random.Random(6)
    for alphabet in ("A", "AC", "ACGT"):
        for k in (1, 2):
            pattern = "".join(rng.choices(alphabet, k=18)).encode()
            texts = ["".join(rng.choices(alphabet, k=rng.randrange(50))).encode() for _ in range(60)] + [pattern[:7] + pattern[8:], pattern + b"A", b"\0" + pattern]
            assert fuzzy.find_many(texts, pattern, k) == [fuzzy.find(t, pattern, k) for t in texts]


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    """However many reads that all differ it has seen."""
    from spliceloom.config import build_config
    from spliceloom.functions import fuzzy

    reader = chain.Reader(build_config(genome=driver.GENOME))
    assert reader.locate.cache_info().maxsize + fuzzy._align.cache_info().maxsize + fuzzy.WINDOWS <= 1 << 16
    monkeypatch.setattr(fuzzy, "WINDOWS", 500)
    rng = random.Random(7)
    d1 = reader.c.sites["D1"]
    for _ in range(10):
        texts = [("".join(rng.choices("ACGT", k=20)) + d1[:5] + rng.choice("ACGT") + d1[6:] + "".join(rng.choices("ACGT", k=60))).encode() for _ in range(200)]
        reader.read_many(texts)
    assert 0 < sum(map(len, fuzzy._aligned.values())) <= 500 + 3 * 200


@pytest.mark.parametrize("name", ["splice_events_one_edit", "joined_records"])
def test_reads_are_derived_once_a_row(spark, name):
    """Not once for each filter on them and again for what is made of them."""
    below, above = [part for part in plan(driver.QUERIES[name](spark, SF)).split("Generate inline")][::-1]
    assert "reverse(translate" in below and "translate" not in above
