"""Paired FASTA/FASTQ files, plain or gzip, as a Spark data source named ``readpairs``.

    read_pairs(spark, a, b)

Pairs are by position; the shorter file ends the table; ids are never compared.
A file may be a folder of parts, which are read one after another in the order of
their names, and several pairs may be given as lists with commas.

Files are read in byte ranges, with a task for each range of the first file.  A
first job counts the records of every range of both files; the sums of the counts
give each range its place in the table, and tell each task at which byte of the
second file the partners of its records begin.  So nothing is shuffled and no task
reads a whole file.  Gzip files are cut between members (bgzip makes many); a
pair with a gzip file of a single member is one partition, as are small ones.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files, ranges

SCHEMA = "pair int, read_ix bigint, id string, r1 string, r2 string"
#: Rows of an Arrow batch, and ranges that the driver plans at most.
BATCH, MOST_RANGES = 8192, 50_000
ENDINGS = {".fasta": "fasta", ".fa": "fasta", ".fastq": "fastq", ".fq": "fastq"}


def data_type(path: str) -> tuple[str, bool]:
    """(fasta or fastq, compressed) by the name's ending; case matters."""
    packed = path.endswith(".gz")
    plain = path[:-3] if packed else path
    for ending, kind in ENDINGS.items():
        if plain.endswith(ending):
            return kind, packed
    raise ValueError(f"neither FASTA nor FASTQ by its name: {path}")


def check_pair(r1: str, r2: str) -> tuple[str, bool]:
    a, b = data_type(r1), data_type(r2)
    if a != b:
        raise ValueError(f"the files of a pair must be of one type: {r1}, {r2}")
    return a


def records(path: str) -> Iterator[tuple[str, str, str]]:
    """(id, description, sequence) of each record; qualities are dropped."""
    kind, packed = data_type(path)
    for part, _ in files.parts(path):
        with files.open_bytes(part) as f:
            for _, head, sequence in ranges.records(ranges.Lines(f, packed, (0, 0)), kind):
                name, _, rest = head.rstrip(b"\r\n").decode().partition(" ")
                yield name, rest, sequence.decode()


class _Range(InputPartition):
    def __init__(self, item: int, path: str, kind: str, packed: bool, lo: int, hi: int):
        self.item, self.path, self.kind, self.packed, self.lo, self.hi = item, path, kind, packed, lo, hi


class _Planned(DataSourceReader):
    """A reader of which tasks get no more than their own partition: with the plan of all of them the bytes sent would grow with the square of the ranges."""

    def __getstate__(self) -> dict:
        return {}


class _Counter(_Planned):
    def __init__(self, options: dict[str, str]):
        self.items = [_Range(i, *x) for i, x in enumerate(json.loads(options["ranges"]))]

    def partitions(self) -> list[InputPartition]:
        return self.items

    def read(self, at: _Range) -> Iterator[tuple]:
        with files.open_bytes(at.path) as f:
            found = ranges.count(f, at.kind, at.packed, at.lo, at.hi)
        yield at.item, found.n, found.first and list(found.first), found.after and list(found.after), [[n, *p] for n, p in found.marks]


class ReadRanges(DataSource):
    """How many records begin in each of the ranges given as JSON, and where."""

    @classmethod
    def name(cls) -> str:
        return "readranges"

    def schema(self) -> str:
        return "item int, n bigint, first array<bigint>, after array<bigint>, marks array<array<bigint>>"

    def reader(self, schema) -> DataSourceReader:
        return _Counter(self.options)


class _Zip(InputPartition):
    """Of one pair, ``n`` records from number ``ix`` on (all for n = None), each file from a byte of a part on, less some records."""

    def __init__(self, pair: int, kind: str, packed: list[bool], ix: int, n: int | None, starts: list):
        self.pair, self.kind, self.packed, self.ix, self.n, self.starts = pair, kind, packed, ix, n, starts


class _Reader(_Planned):
    def __init__(self, options: dict[str, str]):
        self.tasks = [_Zip(*x) for x in json.loads(options["tasks"])]

    def partitions(self) -> list[InputPartition]:
        return self.tasks

    def read(self, t: _Zip) -> Iterator[pa.RecordBatch]:
        first, second = (_from(t.kind, packed, *start) for packed, start in zip(t.packed, t.starts))
        both, ix = islice(zip(first, second), t.n), t.ix
        while rows := list(islice(both, BATCH)):
            text = lambda values: pa.array(values, pa.binary()).cast(pa.string())
            ids = pa.array([ranges.name_of(a[1]) for a, _ in rows], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), t.pair, np.int32)), pa.array(np.arange(ix, ix + len(rows))), ids, text([a[2] for a, _ in rows]), text([b[2] for _, b in rows])], names=["pair", "read_ix", "id", "r1", "r2"]
            )
            ix += len(rows)


def _from(kind: str, packed: bool, paths: list[str], at: list[int], skip: int) -> Iterator[tuple]:
    def every() -> Iterator[tuple]:
        for i, path in enumerate(paths):
            with files.open_bytes(path) as f:
                yield from ranges.records(ranges.Lines(f, packed, (at[0], at[1]) if i == 0 else (0, 0)), kind)

    return islice(every(), skip, None)


class ReadPairs(DataSource):
    @classmethod
    def name(cls) -> str:
        return "readpairs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Place(NamedTuple):
    """Records of a range by their numbers in the whole file."""

    ix: int
    part: int
    found: ranges.Found


def _cut(parts: list[tuple[str, int]], kind: str, packed: bool, size: int) -> list[tuple]:
    return [(path, kind, packed, lo, min(lo + size, n)) for path, n in parts for lo in range(0, max(n, 1), size)]


def _placed(items: list[tuple], found: list[ranges.Found]) -> list[_Place] | None:
    """The ranges that hold records, None if they do not agree or are too few to share out."""
    paths = list(dict.fromkeys(x[0] for x in items))
    for path in paths:
        if not ranges.chained([f for x, f in zip(items, found) if x[0] == path]):
            return None
    at, out = 0, []
    for x, f in zip(items, found):
        if f.n:
            out.append(_Place(at, paths.index(x[0]), f))
            at += f.n
    return out if len(out) > 1 else None


def _tasks(pair: int, kind: str, packed: list[bool], paths: list[list[str]], first: list[_Place], second: list[_Place]) -> list[tuple]:
    """A task for each range of the first file, with where its partners begin in the second."""
    marks = [(p.ix + n, p.part, at) for p in second for n, at in p.found.marks]
    numbers, starts = [m[0] for m in marks], [p.ix for p in second]
    end = second[-1].ix + second[-1].found.n
    out = []
    for p in first:
        if p.ix >= end:
            break
        n = min(p.found.n, end - p.ix)
        number, part, at = marks[bisect_right(numbers, p.ix) - 1]
        last = second[bisect_right(starts, p.ix + n - 1) - 1].part
        out.append((pair, kind, packed, p.ix, n, [([paths[0][p.part]], p.found.first, 0), (paths[1][part : last + 1], at, p.ix - number)]))
    return out


def read_pairs(spark: SparkSession, r1: str, r2: str, partitions: int | None = None, range_bytes: int | None = None) -> DataFrame:
    """Pairs of reads; dealt out anew if the scan has fewer than ``partitions`` partitions.

    ``range_bytes``: size of a range; without it some four ranges a core, of 1 to
    64 MB (more beyond MOST_RANGES ranges).
    """
    a, b = ([x for x in given.split(",") if x] for given in (r1, r2))
    if not a or len(a) != len(b):
        raise ValueError("r1 and r2 must name as many files each, one at least")
    types = [check_pair(x, y) for x, y in zip(a, b)]
    packed = [[data_type(x)[1], data_type(y)[1]] for x, y in zip(a, b)]
    parts = [[files.parts(x), files.parts(y)] for x, y in zip(a, b)]
    total = sum(n for pair in parts for side in pair for _, n in side)
    size = range_bytes or max(min(max(total // (4 * spark.sparkContext.defaultParallelism), 1 << 20), 64 << 20), total // MOST_RANGES)
    large = [i for i, pair in enumerate(parts) if any(len(side) > 1 or side and side[0][1] > size for side in pair)]
    items = {(i, s): _cut(parts[i][s], types[i][0], packed[i][s], size) for i in large for s in (0, 1)}
    found = _counted(spark, items)
    tasks = []
    for i, pair in enumerate(parts):
        paths = [[path for path, _ in side] for side in pair]
        places = [_placed(items[i, s], found[i, s]) for s in (0, 1)] if i in large else [None]
        if all(places):
            tasks += _tasks(i, types[i][0], packed[i], paths, *places)
        else:
            tasks.append((i, types[i][0], packed[i], 0, None, [(p, (0, 0), 0) for p in paths]))
    spark.dataSource.register(ReadPairs)
    df = spark.read.format("readpairs").option("tasks", json.dumps(tasks)).load()
    return df.repartition(partitions) if partitions and partitions > len(tasks) else df


def _counted(spark: SparkSession, items: dict[tuple[int, int], list[tuple]]) -> dict[tuple[int, int], list[ranges.Found]]:
    """What each range holds, in the order of the ranges: a job with a task for each; a row for each comes to the driver."""
    every = [x for xs in items.values() for x in xs]
    if not every:
        return {}
    spark.dataSource.register(ReadRanges)
    rows = spark.read.format("readranges").option("ranges", json.dumps(every)).load().collect()
    place = lambda p: p and (p[0], p[1])
    found = iter([ranges.Found(r.n, place(r.first), place(r.after), [(n, (x, y)) for n, x, y in r.marks]) for r in sorted(rows)])
    return {key: [next(found) for _ in xs] for key, xs in items.items()}


def genome(path: str | None = None) -> str:
    """Sequence of the first record of a FASTA file, or the built-in genome, which serves all built-in strains."""
    return next(records(path or str(Path(__file__).parent.parent / "data" / "nl43.fasta")))[2].upper()
