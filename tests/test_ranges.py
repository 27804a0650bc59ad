"""Byte ranges of sequence files against the sequential reader; the sink and its failures."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from spliceloom.sources import files, ranges, reads, writer


def fastq(n, seed, blanks=True):
    """Records whose qualities often begin with @ or +, of length 0 to 90."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        size = r.choice([0, 1, 30, 30, 90])
        out.append(f"@{i}:{r.randrange(99)} x\n{''.join(r.choices('ACGTN', k=size))}\n+{r.choice(['', 'again'])}\n{''.join(r.choices('@+>I!', k=size))}\n")
        if blanks and r.random() < 0.05:
            out.append("\n")
    return "".join(out).encode()


def fasta(n, seed):
    r = random.Random(seed)
    return "".join(f">{i} d{i}\n" + "".join("".join(r.choices("ACGT", k=r.randrange(40))) + "\n" for _ in range(r.randrange(4))) for i in range(n)).encode()


def blocked(data, size=3000):
    return b"".join(writer.member(data[i : i + size]) for i in range(0, len(data), size)) + writer.LAST


def members(data, seed):
    """Ordinary gzip members of any size, some empty."""
    r = random.Random(seed)
    cuts = sorted(r.randrange(len(data)) for _ in range(25))
    return b"".join(gzip.compress(data[a:b]) for a, b in zip([0, *cuts], [*cuts, len(data)]))


FORMS = {
    "a.fastq": lambda n, s: fastq(n, s), "a.fasta": lambda n, s: fasta(n, s), "b.fastq.gz": lambda n, s: blocked(fastq(n, s)), "m.fastq.gz": lambda n, s: members(fastq(n, s), s), "b.fa.gz": lambda n, s: blocked(fasta(n, s)),
    "crlf.fq": lambda n, s: fastq(n, s, False).replace(b"\n", b"\r\n"), "crlf.fq.gz": lambda n, s: blocked(fastq(n, s).replace(b"\n", b"\r\n")),
}


@pytest.mark.parametrize("name", FORMS)
def test_ranges_chain_and_count_every_record(tmp_path, name):
    """Cut points drawn at random, some in every byte of a stretch."""
    path = str(tmp_path / name)
    (tmp_path / name).write_bytes(FORMS[name](400, 1))
    kind, packed = reads.data_type(path)
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        every = [(p, ranges.name_of(h), s) for p, h, s in ranges.records(ranges.Lines(f, packed, (0, 0)), kind)]
        assert len(every) == 400 and [(n, s.decode()) for _, n, s in every] == [(i, s) for i, _, s in reads.records(path)]
        r = random.Random(2)
        for trial in range(30):
            cuts = sorted({0, size, *r.sample(range(1, size), r.randrange(1, 40))}) if trial else [0, *range(1, 200), size]
            found = [ranges.count(f, kind, packed, a, b) for a, b in zip(cuts, cuts[1:])]
            assert ranges.chained(found) and sum(x.n for x in found) == 400
            at = 0
            for x in found:
                assert len(x.marks) <= ranges.MARKS and (x.n == 0 or x.first == every[at][0])
                for n, p in x.marks:
                    assert next(ranges.records(ranges.Lines(f, packed, p), kind))[1:] == next(ranges.records(ranges.Lines(f, packed, every[at + n][0]), kind))[1:]
                    assert p == every[at + n][0]
                at += x.n


def test_wrong_places_do_not_chain():
    a, b = ranges.Found(3, (0, 0), (90, 0), []), ranges.Found(2, (91, 0), None, [])
    assert not ranges.chained([a, b]) and not ranges.chained([a]) and ranges.chained([a, ranges.Found(0, None, None, []), ranges.Found(1, (90, 0), None, [])])


def in_order(df):
    return [tuple(r) for r in df.orderBy("read_ix").collect()]


@pytest.mark.parametrize("a, b", [("a.fastq", "a.fastq"), ("b.fastq.gz", "b.fastq.gz"), ("m.fastq.gz", "b.fastq.gz"), ("a.fasta", "a.fasta")])
def test_pairs_equal_the_sequential_reader(spark, tmp_path, a, b):
    """100,000 pairs, the second file longer and cut elsewhere."""
    one, two = str(tmp_path / f"1{a}"), str(tmp_path / f"2{b}")
    (tmp_path / f"1{a}").write_bytes(FORMS[a](100_000, 3))
    (tmp_path / f"2{b}").write_bytes(FORMS[b](100_500, 4))
    want = [(0, i, x[0], x[2], y[2]) for i, (x, y) in enumerate(zip(reads.records(one), reads.records(two)))]
    df = reads.read_pairs(spark, one, two, range_bytes=os.path.getsize(one) // 12 + 7)
    assert df.rdd.getNumPartitions() >= 8 and in_order(df) == want
    swapped = reads.read_pairs(spark, two, one, range_bytes=os.path.getsize(one) // 9)
    assert swapped.rdd.getNumPartitions() >= 8 and in_order(swapped) == [(p, i, y[0], y[2], x[2]) for (p, i, *_), x, y in zip(want, reads.records(one), reads.records(two))]


def test_single_member_small_and_empty_files_are_one_task(spark, tmp_path):
    data = fastq(3000, 5)
    for n in (1, 2):
        (tmp_path / f"{n}.fq.gz").write_bytes(gzip.compress(data))
        (tmp_path / f"{n}.fq").write_bytes(data)
        (tmp_path / f"{n}.fa").write_bytes(b"")
    single = reads.read_pairs(spark, str(tmp_path / "1.fq.gz"), str(tmp_path / "2.fq.gz"), range_bytes=4000)
    assert single.rdd.getNumPartitions() == 1 and single.count() == 3000
    assert reads.read_pairs(spark, str(tmp_path / "1.fa"), str(tmp_path / "2.fa"), range_bytes=10).count() == 0
    several = reads.read_pairs(spark, f"{tmp_path}/1.fq,{tmp_path}/1.fa,{tmp_path}/1.fq.gz", f"{tmp_path}/2.fq,{tmp_path}/2.fa,{tmp_path}/2.fq.gz", range_bytes=20_000)
    assert several.groupBy("pair").agg(F.count("*"), F.max("read_ix")).orderBy("pair").collect() == [(0, 3000, 2999), (2, 3000, 2999)]
    assert several.rdd.getNumPartitions() > 8
    assert reads.read_pairs(spark, str(tmp_path / "1.fq"), str(tmp_path / "2.fq"), partitions=6).rdd.getNumPartitions() == 6


def test_broken_record_is_an_error(spark, tmp_path):
    (tmp_path / "1.fq").write_bytes(fastq(2000, 6) + b"@broken\nACGT\n+\nI\n" + fastq(2000, 7))
    with pytest.raises(Exception, match="broken FASTQ record"):
        reads.read_pairs(spark, str(tmp_path / "1.fq"), str(tmp_path / "1.fq"), range_bytes=10_000).count()


@pytest.mark.parametrize("ending", ["fasta", "fq", "fastq.gz", "fa.gz"])
def test_sink_writes_parts_that_read_back(spark, tmp_path, ending):
    rows = spark.range(5000).select(F.col("id").alias("read_ix"), F.concat(F.lit("r"), "id").alias("id"), F.repeat(F.lit("ACGT"), (F.col("id") % 40).cast("int")).alias("r1"), F.repeat(F.lit("GT"), (F.col("id") % 33).cast("int")).alias("r2")).repartition(8)
    one, two = f"{tmp_path}/r1.{ending}", f"{tmp_path}/r2.{ending}"
    for _ in range(2):  # the second time over what stands there
        writer.write_pairs(rows, one, two)
    parts = files.parts(one)
    assert len(parts) >= 4 and sorted(os.listdir(one)) == [os.path.basename(p) for p, _ in parts]
    back = reads.read_pairs(spark, one, two, range_bytes=20_000)
    assert [r[1:] for r in in_order(back)] == [(i, f"r{i}_r1", "ACGT" * (i % 40), "GT" * (i % 33)) for i in range(5000)]
    assert back.rdd.getNumPartitions() >= 4
    writer.as_one_file(spark, one, f"{tmp_path}/one.{ending}")
    assert [x[0] for x in reads.records(f"{tmp_path}/one.{ending}")] == [f"r{i}_r1" for i in range(5000)] and not os.path.exists(one)
    with pytest.raises(Exception, match="holds files already"):
        writer.write_sequences(rows.select(F.col("id").alias("head"), F.col("r1").alias("sequence")), two, overwrite=False)


def test_failed_task_leaves_nothing(spark, tmp_path):
    at = f"{tmp_path}/x.fastq"
    good = spark.range(100, numPartitions=4).select(F.col("id").cast("string").alias("head"), F.lit("ACGT").alias("sequence"))
    bad = good.withColumn("sequence", F.when(F.col("head") == "77", F.raise_error(F.lit("lost"))).otherwise(F.col("sequence")))
    with pytest.raises(Exception, match="lost"):
        writer.write_sequences(bad, at)
    assert not os.path.exists(at) or os.listdir(at) == []
    writer.write_sequences(good, at)
    with pytest.raises(Exception, match="lost"):
        writer.write_sequences(bad, at)
    assert [x[0] for x in reads.records(at)] == [str(i) for i in range(100)]


def test_large_member_and_incompressible_text():
    data = random.Random(1).randbytes(writer.MEMBER)
    assert gzip.decompress(writer.member(data) + writer.LAST) == data
    assert len(writer.member(data)) <= 1 << 16
