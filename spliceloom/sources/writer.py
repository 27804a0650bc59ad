"""FASTA and FASTQ files as a Spark sink named ``sequences``: a folder of parts in the table's order.

    write_sequences(df, "out/r1.fastq.gz")

Each task writes one part under a name of its own in a hidden folder; the commit
gives the parts their final names, an abort takes the hidden folder away, so a
failed task or job leaves nothing behind.  Parts are files by themselves and one
file when put together in order.  Gzip parts are made of members of 64 KB with
their size in the header (bgzip's layout), so that readers can begin at any of them.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.lineage import cut, let_go
from . import files
from .reads import check_pair, data_type

#: Bytes of text in a gzip member, and the empty member that ends a file (fixed value of the layout).
MEMBER = 0xFF00
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

#: Rows of a part at most, where the number of parts is not given: what one task sorts.
PART_ROWS = 100_000


def member(data: bytes) -> bytes:
    """One gzip member, at most MEMBER bytes of text, with its size in the extra field BC."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    if len(body) + 26 > 1 << 16:  # what cannot be packed is stored
        packer = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = packer.compress(data) + packer.flush()
    return struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def text_of(kind: str, head: pa.Array, sequence: pa.Array) -> memoryview:
    """Records of a batch, put together by column."""
    of = lambda text: pa.scalar(text, head.type)
    if kind == "fasta":
        parts = [of(">"), head, of("\n"), sequence, of("\n")]
    else:
        parts = [of("@"), head, of("\n"), sequence, of("\n+\n"), pc.binary_repeat(of("I"), pc.utf8_length(sequence)), of("\n")]
    text = pc.binary_join_element_wise(*parts, of(""), null_handling="replace", null_replacement="None")
    if not len(text):
        return memoryview(b"")
    _, offsets, data = text.buffers()  # the records lie one after another already
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(text.type) else np.int32)
    return memoryview(data)[ends[text.offset] : ends[text.offset + len(text)]]


@dataclass
class Part(WriterCommitMessage):
    number: int
    name: str


class _Out:
    """A folder of parts, and the part that a task writes."""

    def __init__(self, path: str, overwrite: bool):
        self.path = path.rstrip("/")
        self.kind, self.packed = data_type(self.path)
        self.hidden = f"{self.path}/_writing-{uuid.uuid4().hex}"
        if not overwrite and files.exists(self.path) and files.parts(self.path):
            raise ValueError(f"{self.path} holds files already")

    @contextmanager
    def part(self, name: str) -> Iterator[Callable[[pa.Array, pa.Array], None]]:
        """Takes heads and sequences."""
        there, where = files.system(f"{self.hidden}/{name}")
        there.create_dir(where.rpartition("/")[0], recursive=True)
        with there.open_output_stream(where, compression=None) as out:
            held = b""

            def add(head: pa.Array, sequence: pa.Array) -> None:
                nonlocal held
                text = text_of(self.kind, head, sequence)
                if not self.packed:
                    out.write(text)
                    return
                held += text
                full = len(held) // MEMBER * MEMBER
                for i in range(0, full, MEMBER):
                    out.write(member(held[i : i + MEMBER]))
                held = held[full:]

            yield add
            if self.packed:
                out.write((member(held) if held else b"") + LAST)

    def commit(self, messages: list[Part | None]) -> None:
        there, where = files.system(self.path)
        old = [files.system(p)[1] for p, _ in files.parts(self.path)] if files.exists(self.path) else []
        for x in old:
            there.delete_file(x)
        there.create_dir(where, recursive=True)
        ending = self.path.rpartition("/")[2].partition(".")[2]
        for part in sorted((m for m in messages if m), key=lambda m: m.number):
            there.move(f"{files.system(self.hidden)[1]}/{part.name}", f"{where}/part-{part.number:05d}.{ending}")
        self.abort()

    def abort(self) -> None:
        there, where = files.system(self.hidden)
        if files.exists(self.hidden):
            there.delete_dir(where)


class _Writer(DataSourceArrowWriter):
    """Writes each batch to one folder for each pair of columns (head, sequence)."""

    def __init__(self, outs: list[tuple[_Out, str, str]]):
        self.outs = outs

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        number = TaskContext.get().partitionId()
        name = f"{number}-{uuid.uuid4().hex}"
        with ExitStack() as stack:
            parts = [(stack.enter_context(out.part(name)), head, sequence) for out, head, sequence in self.outs]
            for batch in batches:
                for add, head, sequence in parts:
                    add(batch.column(head), batch.column(sequence))
        return Part(number, name)

    def commit(self, messages: list[Part | None]) -> None:
        for out, *_ in self.outs:
            out.commit(messages)

    def abort(self, messages: list) -> None:
        for out, *_ in self.outs:
            out.abort()


class Sequences(DataSource):
    """Sink of (head, sequence) rows."""

    @classmethod
    def name(cls) -> str:
        return "sequences"

    def schema(self) -> str:
        return "head string, sequence string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer([(_Out(self.options["path"], overwrite), "head", "sequence")])


class SequencePairs(DataSource):
    """Sink of (head1, r1, head2, r2) rows: the two files of a pair, written by the same tasks."""

    @classmethod
    def name(cls) -> str:
        return "sequencepairs"

    def schema(self) -> str:
        return "head1 string, r1 string, head2 string, r2 string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer([(_Out(self.options[f"path{side}"], overwrite), f"head{side}", f"r{side}") for side in (1, 2)])


def write_sequences(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Rows (head, sequence) in the order of their partitions, FASTA or FASTQ (best quality for all bases), gzip or not by the path's ending."""
    df.sparkSession.dataSource.register(Sequences)
    df.select("head", "sequence").write.format("sequences").option("path", path).mode("overwrite" if overwrite else "append").save()


def in_order(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Sorted by ``key`` over ``parts`` tasks: one a core at least, and more the more rows there are."""
    parts = parts or max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    return df.repartitionByRange(parts, key).sortWithinPartitions(key)


def write_pairs(df: DataFrame, r1: str, r2: str, parts: int | None = None, ordered: bool = False) -> None:
    """Read pairs (read_ix, id, r1, r2) as two folders of parts in the order of read_ix; ``ordered``: the rows are in that order."""
    check_pair(r1, r2)
    rows = df.select("read_ix", "id", "r1", "r2")
    rows = (rows if ordered else in_order(rows, "read_ix", parts)).select(F.concat("id", F.lit("_r1")).alias("head1"), "r1", F.concat("id", F.lit("_r2")).alias("head2"), "r2")
    df.sparkSession.dataSource.register(SequencePairs)
    rows.write.format("sequencepairs").option("path1", r1).option("path2", r2).mode("overwrite").save()


def write_joined(events: DataFrame, path: str, parts: int | None = None, ordered: bool = False) -> None:
    """Joined reads under their descriptions, in the order of read_ix; ``ordered``: the rows are in that order."""
    head = F.concat("sequence_id", F.lit("-joined ForwardNs: "), "forward_ns", F.lit(", UMI: "), "umi")
    joined = events.where("joined_sequence is not null").select("read_ix", head.alias("head"), F.col("joined_sequence").alias("sequence"))
    if ordered:
        write_sequences(joined, path)
        return
    joined = cut(joined)  # ranges are drawn from the rows before they are sorted
    write_sequences(in_order(joined, "read_ix", parts), path)
    let_go(joined)


def as_one_file(spark: SparkSession, folder: str, path: str) -> None:
    """The parts of a folder put together byte by byte (on the driver, for small files), and the folder deleted."""
    there, where = files.system(path)
    with there.open_output_stream(where, compression=None) as out:
        for part, _ in files.parts(folder):
            with files.open_bytes(part) as f:
                while data := f.read(1 << 20):
                    out.write(data)
    files.delete(spark, folder)
