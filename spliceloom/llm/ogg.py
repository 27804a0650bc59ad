"""Media columns in Ogg: store bytes as 8-bit samples, and read any Ogg bytes back.

Writing: the payload is cut into packets of ``FRAME`` samples, dealt in turn to
two logical streams of unsigned 8-bit mono PCM; pages of both are interleaved.
Reading makes no use of what was written: it walks the pages, verifies their
checksums, reassembles packets from the lacing values (packets may span pages),
demultiplexes the logical streams by serial number and derives each packet's
time from the granule positions.

Defined results: bytes that are no page are skipped to the next capture pattern
and counted; pages with a wrong checksum are counted and left out; a packet with
a missing part is dropped and counted; empty or null bytes have no streams.  A
null or empty text is stored as one frame of bytes 255; a long text is handled
alone; packets that begin at one time (ties) come by serial number; repeated rows
and null ids return their own rows, equal texts with equal values; an empty table
is empty; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keyed, map_text, utf8

FRAME = 576
RATE = 48_000
PAD = 255
CAPTURE = b"OggS"
HEADER = struct.Struct("<4sBBqIIIB")
#: Identification header of 8-bit PCM: magic, version 0.0, format (unsigned 8-bit), rate, bits, channels, packet size, further headers.
PCM = struct.Struct(">8sHHIIBBHI")
MAGIC = b"PCM     "
CONTINUED, FIRST, LAST = 1, 2, 4
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC-32 (polynomial 0x04c11db7, unreflected, from zero), by the reflected one over reversed bits."""
    x = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_REVERSED), "big")


def page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    x = checksum(head + body)
    return head[:22] + x.to_bytes(4, "little") + head[26:] + body


def lace(packet_bytes: int) -> bytes:
    return b"\xff" * (packet_bytes // 255) + bytes([packet_bytes % 255])


def write_stream(serial: int, packets: list[tuple[bytes, int]], segments: int = 255, first: int = 0) -> list[bytes]:
    """Pages of one logical stream; each packet comes with the granule position at its end.

    The first packet has a page of its own; a page holds ``segments`` lacing values at most.
    """
    pages: list[bytes] = []
    lacing, body, granule, flags = bytearray(), bytearray(), -1, 0

    def close(last: bool) -> None:
        nonlocal lacing, body, granule, flags
        kind = flags | (FIRST if not pages else 0) | (LAST if last else 0)
        pages.append(page(serial, first + len(pages), granule, kind, bytes(lacing), bytes(body)))
        lacing, body, granule, flags = bytearray(), bytearray(), -1, 0

    for k, (data, end) in enumerate(packets):
        laced, at = lace(len(data)), 0
        while True:
            if len(lacing) == segments:
                close(False)
                if at:
                    flags = CONTINUED
            take = laced[at : at + segments - len(lacing)]
            start = 255 * at
            lacing += take
            at += len(take)
            body += data[start : min(len(data), 255 * at)]
            if at == len(laced):
                granule = end
                break
        if k == 0 and len(packets) > 1:
            close(False)
    close(True)
    return pages


def write(payload: bytes, frame: int = FRAME, rate: int = RATE, streams: int = 2, segments: int = 255) -> bytes:
    """The payload, a multiple of ``frame`` bytes, as ``streams`` interleaved logical streams."""
    dealt: list[list[tuple[bytes, int]]] = []
    for s in range(streams):
        head = PCM.pack(MAGIC, 0, 0, 1, rate, 8, 1, frame, 0)
        own = range(s * frame, len(payload), streams * frame)
        dealt.append([(head, 0)] + [(payload[i : i + frame], (n + 1) * frame) for n, i in enumerate(own)])
    made = [write_stream(s + 1, p, segments) for s, p in enumerate(dealt)]
    longest = max(map(len, made))
    return b"".join(p[i] for i in range(longest) for p in made if i < len(p))


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: granule position of the page on which the packet ends, and how many packets end after it on that page
    ends: list[tuple[int, int]] = field(default_factory=list)
    pages: int = 0
    begun: bool = False
    ended: bool = False
    partial: bytearray | None = None
    next_number: int | None = None


@dataclass
class Container:
    streams: dict[int, Stream]
    pages: int = 0
    bad_pages: int = 0
    skipped: int = 0
    broken_packets: int = 0


def read(data: bytes) -> Container:
    """All logical streams of any bytes; never raises."""
    out = Container({})
    at, n = 0, len(data)
    while at < n:
        if data[at : at + 4] != CAPTURE:
            to = data.find(CAPTURE, at)
            to = n if to < 0 else to
            out.skipped += to - at
            at = to
            continue
        if at + HEADER.size > n:
            out.skipped += n - at
            break
        _, version, flags, granule, serial, number, crc, count = HEADER.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + count]
        end = at + 27 + count + sum(lacing)
        if version or len(lacing) < count or end > n or checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != crc:
            out.bad_pages += 1
            out.skipped += 4
            at += 4  # a page may still begin inside
            continue
        out.pages += 1
        s = out.streams.setdefault(serial, Stream(serial))
        s.pages += 1
        s.begun |= bool(flags & FIRST)
        s.ended |= bool(flags & LAST)
        lost = s.next_number is not None and number != s.next_number
        s.next_number = number + 1 & 0xFFFFFFFF
        part = s.partial
        if part is not None and (lost or not flags & CONTINUED):
            out.broken_packets += 1
            part = None
        orphan = bool(flags & CONTINUED) and part is None
        body, ends = at + 27 + count, []
        part = part if part is not None else bytearray()
        for size in lacing:
            part += data[body : body + size]
            body += size
            if size < 255:
                if orphan:
                    out.broken_packets += 1
                    orphan = False
                else:
                    ends.append(bytes(part))
                part = bytearray()
        s.packets += ends
        s.ends += [(granule, len(ends) - 1 - k) for k in range(len(ends))]
        s.partial = part if count and lacing[-1] == 255 and not orphan else None
        at = end
    for s in out.streams.values():
        if s.partial is not None:
            out.broken_packets += 1
    return out


def timed(stream: Stream) -> list[tuple[int, bytes]]:
    """(first sample, data) of each data packet of an 8-bit PCM stream, from the pages' granule positions."""
    if not stream.packets or not stream.packets[0].startswith(MAGIC) or len(stream.packets[0]) < PCM.size:
        return []
    width = max(1, PCM.unpack_from(stream.packets[0])[6])
    sizes = [len(p) // width for p in stream.packets]
    out = []
    for k in range(1, len(stream.packets)):
        granule, after = stream.ends[k]
        out.append((granule - sum(sizes[k : k + after + 1]), stream.packets[k]))
    return out


def payload_of(c: Container) -> tuple[bytes, int, int]:
    """Samples of all streams merged by time and then serial number; their number of packets and last sample position."""
    found = sorted((start, s.serial, data) for s in c.streams.values() for start, data in timed(s))
    return b"".join(d for _, _, d in found), len(found), max((start + len(d) for start, _, d in found), default=0)


def feature(c: Container, samples: bytes, packets: int, last: int, rate: int = RATE) -> str:
    """What the container shows, as name=value pairs."""
    mean = sum(samples) / len(samples) if samples else 0.0
    ok = all(s.begun and s.ended for s in c.streams.values())
    return f"streams={len(c.streams)};pages={c.pages};bad={c.bad_pages};packets={packets};broken={c.broken_packets};complete={int(ok)};seconds={last / rate:.6f};mean={mean:.6f}"


def pad(data: bytes, unit: int = FRAME) -> bytes:
    """Bytes 255 appended up to a positive multiple of ``unit``."""
    return data + bytes([PAD]) * ((-len(data)) % unit if data else unit)


def media(docs: DataFrame, with_bytes: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's UTF-8 bytes stored in Ogg and read back: sizes, digests, feature, and the container if asked for."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw, off = utf8(batch.column(1))
            data = raw.tobytes()
            cols: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media")}
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                stored = write(pad(data[a:b]))
                c = read(stored)
                got, packets, last = payload_of(c)
                row = (b - a, len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(c, got, packets, last), stored if with_bytes else None)
                for k, v in zip(cols, row):
                    cols[k].append(v)
            types = {"feature": pa.string(), "media": pa.binary(), "payload_sha256": pa.string(), "media_sha256": pa.string()}
            return {"doc_id": batch.column(0)} | {k: pa.array(v, types.get(k, pa.int64())) for k, v in cols.items()}

        return work

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string" + ", media binary" * with_bytes
    return map_text(docs, keyed(docs, key, text), schema, make)
