"""Byte ranges of sequence files: where records begin, how many there are, and reading on from any of them.

A range owns the records that begin in it after its first line break, and the one
that begins with the first byte after it.  To find its first record, a range that
is not a file's first one skips a line and looks for a record's shape: in FASTQ a
line that begins with ``@`` and whose next but one begins with ``+``.  A quality
line may begin with ``@`` too, but then the next but one is a sequence.

In a gzip file a range owns the members (of which bgzip makes one for each 64 KB)
that begin in it; they are found by their magic number, and by decompressing their
beginning.  A file of a single member is one range.

Whether ranges agree is checked where their counts are added up (``chained``):
each must end where the next one begins, so records found wrongly cannot pass.

A position is (byte, 0) in a plain file and (byte of the member, decompressed byte
in it) in gzip; positions of a file are in the order of its records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple

Position = tuple[int, int]
#: Bytes of a read, and decompressed bytes that a found gzip member must give without error.
BLOCK, TRIAL = 1 << 20, 1 << 16
#: Positions noted within a range at most.
MARKS = 8
MAGIC = b"\x1f\x8b\x08"


class Found(NamedTuple):
    """Records of a range: how many, the first one's position, that of the record after the last, and noted positions by number."""

    n: int
    first: Position | None
    after: Position | None
    marks: list[tuple[int, Position]]


class Lines:
    """Lines with their positions, from a position on; ``edge`` is the first byte that belongs to the next range."""

    def __init__(self, f, packed: bool, at: Position, hi: int | None = None):
        self.f, self.packed, self.at, self.hi = f, packed, at, hi
        self.edge: Position | None = None if packed or hi is None else (hi, 0)

    def __iter__(self) -> Iterator[tuple[Position, bytes]]:
        return self._packed() if self.packed else self._plain()

    def owned(self, p: Position) -> bool:
        return self.hi is None or p[0] < self.hi or p == self.edge

    def _plain(self) -> Iterator[tuple[Position, bytes]]:
        self.f.seek(at := self.at[0])
        for line in self.f:
            yield (at, 0), line
            at += len(line)

    def _packed(self) -> Iterator[tuple[Position, bytes]]:
        held, begun = [], None  # an unfinished line and where it began
        for member, inner, data in _members(self.f, self.at[0]):
            if inner == 0 and self.edge is None and self.hi is not None and member >= self.hi:
                self.edge = (member, 0)
            if member == self.at[0] and inner < self.at[1]:
                skip = min(len(data), self.at[1] - inner)
                data, inner = data[skip:], inner + skip
            for line in data.splitlines(keepends=True) if b"\r" not in data else data.replace(b"\r", b" ").splitlines(keepends=True):
                if begun is None:
                    begun = member, inner
                inner += len(line)
                held.append(line)
                if line.endswith(b"\n"):
                    yield begun, b"".join(held)
                    held, begun = [], None
        if held:
            yield begun, b"".join(held)


def _members(f, at: int) -> Iterator[tuple[int, int, bytes]]:
    """(member, decompressed byte in it, data) from the member at a byte on; data is never empty."""
    f.seek(at)
    raw = f.read(BLOCK)
    while raw:
        member, inner, d = at, 0, zlib.decompressobj(31)
        while not d.eof:
            if not raw and not (raw := f.read(BLOCK)):
                raise EOFError("the gzip file ends inside a member")
            data = d.decompress(raw, BLOCK)
            at += len(raw) - len(d.unused_data) - len(d.unconsumed_tail)
            raw = d.unused_data if d.eof else d.unconsumed_tail
            if data:
                yield member, inner, data
                inner += len(data)
        while not raw.lstrip(b"\0"):  # zeros may fill up a member
            at += len(raw)
            if not (raw := f.read(BLOCK)):
                return
        at += len(raw) - len(raw.lstrip(b"\0"))
        raw = raw.lstrip(b"\0")


def member_from(f, lo: int, hi: int) -> int | None:
    """The first gzip member that begins at lo or later and before hi."""
    at = lo
    while at < hi:
        f.seek(at)
        raw = f.read(min(BLOCK, hi - at) + len(MAGIC) - 1)
        i = raw.find(MAGIC)
        while i >= 0:
            if at + i < hi and _begins(f, at + i):
                return at + i
            i = raw.find(MAGIC, i + 1)
        at += BLOCK
    return None


def _begins(f, at: int) -> bool:
    f.seek(at)
    head = f.read(BLOCK)
    if len(head) < 18 or head[3] & 0xE0:
        return False
    d = zlib.decompressobj(31)
    try:
        data = d.decompress(head, TRIAL)
    except zlib.error:
        return False
    rest = d.unused_data.lstrip(b"\0")
    return min(data, default=32) > 8 and (not d.eof or not rest or rest.startswith(MAGIC[: len(rest)]))


def records(lines: Lines, kind: str, resync: bool = False) -> Iterator[tuple[Position, bytes, bytes]]:
    """(position, head without its mark, sequence) of each record; in the middle of a file from the first that begins after a line break."""
    it = iter(lines)
    if resync:
        next(it, None)
        it = _synced_fastq(lines, it) if kind == "fastq" else _synced_fasta(lines, it)
    return _fastq(it) if kind == "fastq" else _fasta(it)


def _synced_fastq(lines: Lines, it: Iterator) -> Iterator:
    ahead = list(islice(it, 3))
    while len(ahead) == 3 and lines.owned(ahead[0][0]):
        if ahead[0][1].startswith(b"@") and ahead[2][1].startswith(b"+"):
            return chain(ahead, it)
        ahead = [*ahead[1:], *islice(it, 1)]
    return iter(())


def _synced_fasta(lines: Lines, it: Iterator) -> Iterator:
    for at, line in it:
        if not lines.owned(at):
            break
        if line.startswith(b">"):
            return chain([(at, line)], it)
    return iter(())


def _fastq(it: Iterator) -> Iterator[tuple[Position, bytes, bytes]]:
    nothing = None, b""
    for at, head in it:
        if not head.strip():
            continue
        if not head.startswith(b"@"):
            raise ValueError("a FASTQ record must begin with @")
        sequence, plus, quality = next(it, nothing)[1].strip(), next(it, nothing)[1], next(it, nothing)[1].rstrip(b"\r\n ")
        if not plus.startswith(b"+") or len(quality) != len(sequence):
            raise ValueError(f"broken FASTQ record {head.strip().decode(errors='replace')}")
        yield at, head[1:], sequence


def _fasta(it: Iterator) -> Iterator[tuple[Position, bytes, bytes]]:
    begun, head, parts = None, b"", []
    for at, line in it:
        if line.startswith(b">"):
            if begun is not None:
                yield begun, head, b"".join(parts)
            begun, head, parts = at, line[1:], []
        elif begun is not None:
            parts.append(line.strip())
        elif line.strip():
            raise ValueError("a FASTA record must begin with >")
    if begun is not None:
        yield begun, head, b"".join(parts)


def name_of(head: bytes) -> str:
    return head.rstrip(b"\r\n").partition(b" ")[0].decode()


def count(f, kind: str, packed: bool, lo: int, hi: int) -> Found:
    """What a range owns."""
    at = (member_from(f, lo, hi) if lo else 0) if packed else lo
    n, first, marks, step = 0, None, [], 1
    if at is not None:
        lines = Lines(f, packed, (at, 0), hi)
        for p, _, _ in records(lines, kind, resync=lo > 0):
            if not lines.owned(p):
                return Found(n, first, p, marks) if n else Found(0, None, None, [])
            if n % step == 0:
                marks.append((n, p))
                if len(marks) > MARKS:
                    marks, step = marks[::2], 2 * step
            first = p if n == 0 else first
            n += 1
    return Found(n, first, None, marks)


def chained(found: list[Found]) -> bool:
    """Whether ranges of one file, in order, end where the next ones begin."""
    full = [x for x in found if x.n]
    return all(a.after == b.first for a, b in zip(full, full[1:])) and (not full or full[-1].after is None)
