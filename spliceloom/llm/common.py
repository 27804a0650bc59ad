"""Helpers shared by the corpus operators: Arrow text buffers, row keys, word hashes, choice of rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut, let_go  # noqa: F401  the operators take them from here

#: Text handled at once inside a task; rows are never cut, so one longer row is handled alone.
CHUNK_BYTES = 4 << 20
#: Bytes of one Arrow batch on its way to a Python function.
BATCH_BYTES = 4 << 20
#: Rows of a checked table that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: Column | str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column in one piece and the n+1 offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    _, at, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, regrouped to about ``limit`` bytes of text a batch."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, off = utf8(column)
        start = 0
        while start < batch.num_rows:
            # rows that still fit; at least one when nothing is held
            stop = int(np.searchsorted(off, off[start] + max(0, limit - size), side="right")) - 1
            stop = max(stop, start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(off[stop] - off[start])
            if stop < batch.num_rows or size >= limit:
                yield _joined(held)
                held, size = [], 0
            start = stop
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def give_back() -> None:
    """Returns to the system what a finished task has freed: workers live on, and two stand beside each executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _small_batches(spark: SparkSession) -> None:
    """Lowers the session's bytes of an Arrow batch to BATCH_BYTES; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with small batches, whose worker gives its freed memory back at the task's end."""
    _small_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def map_text(df: DataFrame, columns: list, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], limit: int = CHUNK_BYTES) -> DataFrame:
    """mapInArrow over ``columns``, one of which is named ``text``.

    ``make`` runs once in each task and returns the function that turns a batch
    into a dict of output columns (or None for no rows).
    """
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in pieces(batches, limit=limit):
            out = work(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return map_arrow(df.select(*columns), run, schema)


def filter_text(docs: DataFrame, text: str, make: Callable[[], Callable[[pa.Array], np.ndarray]], limit: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns as they are, for whose text the task's function says True; no shuffle."""
    at = docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # any name may stand in the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in pieces(batches, f"c{at}", limit):
            yield batch.filter(pa.array(keep(batch.column(at)), pa.bool_()))

    return map_arrow(plain, run, plain.schema).toDF(*docs.columns)


def _array(x) -> pa.Array:
    if isinstance(x, pa.ChunkedArray):
        return x.combine_chunks()
    return x if isinstance(x, pa.Array) else pa.array(x)


def named(column: str) -> Column:
    """A column by its name, whatever characters the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def keyed(docs: DataFrame, key: str, text: str, *more: Column) -> list[Column]:
    """The key and text columns under the names doc_id and text, whatever else the table holds."""
    return [named(key).alias("doc_id"), named(text).cast("string").alias("text"), *more]


def text_hash(text: str) -> Column:
    """XXH64 of the text, null as empty."""
    return F.xxhash64(F.coalesce(named(text).cast("string"), F.lit("")))


def if_small(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``most`` rows (BROADCAST_ROWS if they are narrow)."""
    most = BROADCAST_ROWS if most is None else most
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def keep_rows(docs: DataFrame, judged: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``judged`` (id, th, many, stays) lets stay; it holds every pair of an id and a text's hash once.

    Where ``many`` rows have one id and text, the row with the smallest hash over
    all its columns stays.  Rows to drop are broadcast up to BROADCAST_ROWS of them,
    so that texts need not be shuffled.
    """
    every = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), named(key).alias("id"), text_hash(text).alias("th"))
    to = judged.toDF("to_id", "to_th", "many", "stays")
    same = every["id"].eqNullSafe(to["to_id"]) & (every["th"] == to["to_th"])
    # gone: losers, and for now the rows of which only one is to stay
    gone = to.where("not stays or many").select("to_id", "to_th")
    once = every.join(if_small(gone), same, "left_anti").select("row.*")
    again = to.where("stays and many").select("to_id", "to_th")
    if again.isEmpty():
        return once
    rows = every.join(if_small(again), same, "left_semi")
    one = rows.groupBy("id", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return once.unionByName(one.select("row.*"))


def word_bounds(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``mask`` holds, broken at row offsets."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    brk = np.zeros(n + 1, bool)
    brk[off] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | brk[1:n]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | brk[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: A random number for each byte at each of 64 places.
_AT = 64
_DRAWN = np.random.default_rng(1).integers(0, 1 << 64, _AT * 256, dtype=np.uint64)


def word_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice ``raw[start:end]``: the sum of a random number for each byte and place, then mixed.

    Beyond 64 bytes the numbers are mixed anew for every further 64, so no pattern
    of bytes cancels out.  Two different words have one hash with odds of about
    2**-64: among a billion distinct words, a pair that does exists with odds of 3 %.
    """
    lens = ends - starts
    out = np.zeros(len(starts), np.uint64)
    step = 1 << 18
    for i in range(0, len(starts), step):
        s, n = starts[i : i + step], lens[i : i + step]
        to = np.cumsum(n)
        at = to - n
        rel = np.arange(int(to[-1])) - np.repeat(at, n)
        x = _DRAWN[(rel & (_AT - 1)) << 8 | raw[rel + np.repeat(s, n)]]
        if len(far := np.flatnonzero(rel >= _AT)):
            x[far] = mixed(x[far] + (rel[far] // _AT).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[i : i + step] = np.add.reduceat(x, at) + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed(out)


def ascii_lower() -> np.ndarray:
    """Byte table that lower-cases A-Z alone."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t
