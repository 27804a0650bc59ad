import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spliceloom.llm import common


def test_pieces_keep_rows_and_order():
    texts = ["a" * n for n in (5, 0, 100, 3, 7, 50)] + [None, "é"]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 4)), pa.array(texts[i : i + 4], pa.string())], names=["k", "text"]) for i in (0, 4)]
    for limit in (1, 10, 60, 10_000):
        got = list(common.pieces(batches, limit=limit))
        assert [x for b in got for x in b.column(0).to_pylist()] == list(range(8))
        assert [x for b in got for x in b.column(1).to_pylist()] == texts
        assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column(1).to_pylist()) <= limit for b in got)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_utf8_of_slices(kind):
    column = pa.array(["ab", None, "é", "", "xyz"], kind).slice(1, 3)
    raw, off = common.utf8(column)
    assert raw.tobytes() == "é".encode() and off.tolist() == [0, 0, 2, 2]
    assert common.utf8(pa.array([], kind))[1].tolist() == [0]


def test_words_do_not_cross_rows():
    raw, off = common.utf8(pa.array(["ab", "cd e", "", "f"]))
    s, e = common.word_bounds(raw != 32, off)
    assert [raw[a:b].tobytes() for a, b in zip(s, e)] == [b"ab", b"cd", b"e", b"f"]


def test_word_hashes_tell_words_apart():
    words = sorted({f"{a}{b}" for a in "abcdefgh\x00" for b in ["", "a", "aa", "\x00", "b" * 50, "xyz" * 300]})
    raw, off = common.utf8(pa.array(words))
    h = common.word_hash(raw, off[:-1], off[1:])
    assert len(set(h.tolist())) == len(words)
    again = common.word_hash(np.concatenate([raw, raw]), np.concatenate([off[:-1], off[:-1] + len(raw)]), np.concatenate([off[1:], off[1:] + len(raw)]))
    assert (again == np.tile(h, 2)).all()


def test_crc_mod(spark):
    import zlib

    df = spark.createDataFrame([(7,), (None,), (-3,)], "doc_id long")
    got = [r[0] for r in df.select(common.crc_mod("doc_id", 7)).collect()]
    assert got == [zlib.crc32(b"7") % 7, 0, zlib.crc32(b"-3") % 7]


def test_cut_uses_the_named_folder(spark):
    df = common.cut(spark.range(5).select((F.col("id") * 2).alias("x")))
    assert df.count() == 5
    where = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir").split(":")[-1] in where
