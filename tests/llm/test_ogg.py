import hashlib
import random
import zlib

from spliceloom.llm import ogg, queries


def slow_crc(data):
    """Ogg's checksum bit by bit."""
    r = 0
    for b in data:
        r ^= b << 24
        for _ in range(8):
            r = (r << 1 ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
    return r


def test_checksum():
    rng = random.Random(0)
    for n in (0, 1, 5, 300):
        d = rng.randbytes(n)
        assert ogg.checksum(d) == slow_crc(d)


def test_round_trips():
    rng = random.Random(1)
    for n in (0, 1, 575, 576, 577, 1153, 50_000, 200_000):
        data = ogg.pad(rng.randbytes(n))
        assert len(data) % 576 == 0 and len(data) >= max(n, 576)
        for streams, segments in ((2, 255), (1, 255), (3, 255), (2, 1), (2, 2), (1, 4)):
            c = ogg.read(ogg.write(data, streams=streams, segments=segments))
            assert ogg.payload_of(c)[0] == data, (n, streams, segments)
            assert c.bad_pages == c.broken_packets == c.skipped == 0 and len(c.streams) == streams
            assert all(s.begun and s.ended for s in c.streams.values())


def test_packets_of_any_size_and_lacing_edges():
    for size in (0, 1, 254, 255, 256, 510, 65025, 65026, 70000):
        packets = [(b"head", 0), (bytes([size % 251]) * size, 7), (b"tail", 9)]
        for segments in (1, 3, 255):
            c = ogg.read(b"".join(ogg.write_stream(5, packets, segments)))
            assert c.streams[5].packets == [p for p, _ in packets]


def test_times_come_from_granules():
    c = ogg.read(ogg.write(bytes(576 * 200), streams=1))
    assert [t for t, _ in ogg.timed(c.streams[1])] == [576 * k for k in range(200)]


def test_damage_is_found():
    data = ogg.pad(bytes(range(256)) * 1000)
    good = ogg.write(data, streams=1)
    second = good.find(b"OggS", good.find(b"OggS", 30) + 4)
    bad = bytearray(good)
    bad[second + 400] ^= 1
    c = ogg.read(bytes(bad))
    assert c.bad_pages >= 1 and len(ogg.payload_of(c)[0]) < len(data)
    c = ogg.read(b"junk" + good + b"Og")
    assert c.skipped == 6 and ogg.payload_of(c)[0] == data
    for junk in (b"", b"OggS", b"OggS" + bytes(30), good[: len(good) // 2]):
        ogg.payload_of(ogg.read(junk))


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = queries.op2_ogg(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        want = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
        assert r.media_bytes > r.payload_bytes


def test_edge_rows(make_docs):
    docs = make_docs([None, "", "x", (None, "x"), (2, "x"), (3, "é" * 300_000)], extra=True)
    got = ogg.media(docs, with_bytes=True).collect()
    assert sorted(r.payload_bytes for r in got) == [576] * 5 + [600192]
    for r in got:
        assert hashlib.sha256(r.media).hexdigest() == r.media_sha256
    assert ogg.media(docs.limit(0)).collect() == []
