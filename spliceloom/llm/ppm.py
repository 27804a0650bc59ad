"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie of order ``ORDER`` = 5 learned from the training
rows: a context's symbol has probability n / (T + D), an escape to the next
shorter context D / (T + D), where T counts the context's occurrences and D its
distinct symbols.  After an escape the symbols of the longer context are excluded.
A longer context's symbols are always symbols of its suffix, so what an escape
excludes is one number per context (the suffix's count of the context's symbols)
and exclusion is exact.  The end of a text is a symbol of its own, and what no
context has seen shares the rest evenly.  The same pass gives an add-one unigram
base score over lower-cased words.

Nothing of the corpus's size is broadcast or collected.  Rows are packed into
pieces of bounded size; each piece sends its distinct six-byte grams and words
with their training counts to shards by hash; shards add them up; shorter
contexts are sums of longer ones, made with DataFrame aggregations and joins; and
each piece gets back one value per gram and word that it holds.  A gram or word
takes one entry per piece, however often it occurs.  There are as many shards as
pieces, so that a shard's share does not grow with the input.

Defined results: null text is empty text (an end and nothing else); a long text is
a piece of its own; words are told apart by 64-bit hashes (``common.word_hash`` has
the odds); without training rows every byte has probability 1/256; repeated rows
count and return each time; a null id is crc32 of empty text for the caller's
split; an empty table is empty; other columns of the table are not read, but by
``learn``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, keyed, map_arrow, mixed, pieces, utf8, word_bounds, word_hash

ORDER = 5
#: Bytes that UTF-8 never has: before a text's begin, and its end.
BEFORE, END = 0xFE, 0xFF
SYMBOLS = 256
PIECE_BYTES = 16 << 20
#: Bytes of a piece whose grams are held at once.
STEP_BYTES = 2 << 20
#: Shards by a gram's first three bytes; more shards than this divide each of these by the next two bytes.
COARSE_SHARDS = 1024
GRAMS, WORDS = 0, 1


def grams(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end to predict: its five context bytes and itself as one number; and its row."""
    lens = np.diff(off)
    size = lens + ORDER + 1
    start = np.cumsum(size) - size
    buf = np.full(int(size.sum()), BEFORE, np.uint8)
    buf[np.arange(len(raw)) + np.repeat(start + ORDER - off[:-1], lens)] = raw
    buf[start + ORDER + lens] = END
    n = len(buf) - ORDER
    key = buf[:n].astype(np.int64)
    for j in range(1, ORDER + 1):
        key <<= 8
        key |= buf[j : n + j]
    return key[buf[ORDER:] != BEFORE], np.repeat(np.arange(len(lens), dtype=np.int32), lens + 1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: The end of a text as a token; no word is a blank.
END_WORD = int(word_hash(np.array([0x20], np.uint8), np.array([0]), np.array([1])).view(np.int64)[0])


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and one end per row; and their rows."""
    low = ascii_lower()[raw]
    s, e = word_bounds(~_SPACE[low], off)
    rows = len(off) - 1
    return np.concatenate([word_hash(low, s, e).view(np.int64), np.full(rows, END_WORD)]), np.concatenate([np.searchsorted(off, s, side="right") - 1, np.arange(rows)])


def _squeeze(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, bytes of like weight together; sorted keys as their differences."""
    if x.dtype == np.int64:
        x = np.diff(x, prepend=0)
    plain = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


def _expand(data: bytes, kind) -> np.ndarray:
    """The inverse: ``kind`` is int64 for sorted keys, else a width that is kept as it is."""
    n = int.from_bytes(data[:8], "little")
    width = np.dtype(kind).itemsize
    plain = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    x = np.ascontiguousarray(plain.reshape(width, n).T).reshape(-1).view(kind)
    return np.cumsum(x) if kind == np.int64 else x


def _pack(docs: DataFrame, learn: Column, key: str, text: str, limit: int) -> DataFrame:
    """Rows (piece, rows): pieces of the table, written out once so that their numbers hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        for k, batch in enumerate(pieces(batches, limit=limit)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([base + k]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["piece", "rows"])

    return cut(map_arrow(docs.select(*keyed(docs, key, text), F.coalesce(learn, F.lit(False)).alias("learn")), run, "piece bigint, rows binary"))


def _unpack(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _steps(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about STEP_BYTES; one row at least."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + STEP_BYTES, side="right")) - 1)
        yield a, b
        a = b


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k = k[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(c[order], at) if len(k) else c


def _counted(split, raw: np.ndarray, off: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all rows, sorted, and their counts in the rows to learn from."""
    keys, counts = [], []
    for a, b in _steps(raw, off):
        key, row = split(raw[off[a] : off[b]], off[a : b + 1] - off[a])
        use = learn[a:b][row]
        own, n = np.unique(key[use], return_counts=True)
        rest = np.unique(key[~use])
        keys += [own, rest]
        counts += [n, np.zeros(len(rest), np.int64)]
        if len(keys) >= 8:
            k, c = _added(keys, counts)
            keys, counts = [k], [c]
    return _added(keys, counts)


def _shard_of(key: np.ndarray, kind: int, shards: int) -> np.ndarray:
    """Even shards for grams, odd ones for words.

    Grams go by their first three bytes, so that a shard's keys lie close together.
    Beyond COARSE_SHARDS each of these is divided by the two bytes after them as
    well, so that no beginning, however common, stays in one shard.
    """
    if kind == GRAMS:
        coarse, fine = min(shards, COARSE_SHARDS), -(-shards // COARSE_SHARDS)
        shard = (mixed((key >> 24).view(np.uint64)) % np.uint64(coarse)).astype(np.int64)
        if fine > 1:
            shard = shard * fine + (mixed((key >> 8).view(np.uint64)) % np.uint64(fine)).astype(np.int64)
        return shard * 2
    return ((key.view(np.uint64) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64) * 2 + 1


def _split(key: np.ndarray, kind: int, shards: int) -> list[tuple[int, np.ndarray]]:
    """(shard, places of its keys in ``key``), by shard."""
    shard = _shard_of(key, kind, shards)
    order = np.argsort(shard, kind="stable")
    at = np.flatnonzero(np.diff(shard[order], prepend=-1))
    return [(int(shard[order[a]]), order[a:b]) for a, b in zip(at, np.append(at[1:], len(key)))]


def _requests(packed: DataFrame, shards: int) -> DataFrame:
    """(shard, piece, keys, counts): what each piece holds of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = _unpack(data.as_py())
                learn = np.array(rows.column(2).to_pylist(), bool)
                raw, off = utf8(rows.column(1))
                for kind, split in ((GRAMS, grams), (WORDS, words)):
                    key, n = _counted(split, raw, off, learn)
                    parts = _split(key, kind, shards)
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in parts], pa.int32()), pa.array([piece] * len(parts), pa.int64()), pa.array([_squeeze(key[i]) for _, i in parts], pa.binary()), pa.array([_squeeze(n[i].astype(np.int32)) for _, i in parts], pa.binary())], names=["shard", "piece", "keys", "counts"])

    return cut(map_arrow(packed, run, "shard int, piece bigint, keys binary, counts binary"))


def _merged(requests: DataFrame) -> DataFrame:
    """Every distinct key with its training count; a task holds one shard's distinct keys.

    Grams come one a row (shard, key, n); words as blocks (shard, keys, counts) with
    the block's training tokens n and distinct training words v.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, held, base = None, [], [], 0, 0
        names = ["shard", "key", "n", "v", "keys", "counts"]

        def out() -> Iterator[pa.RecordBatch]:
            k, c = _added(keys, counts)
            for i in range(0, len(k), 50_000):
                x, y = k[i : i + 50_000], c[i : i + 50_000]
                if now % 2 == GRAMS:
                    none = pa.nulls(len(x), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), now, np.int32)), pa.array(x), pa.array(y), pa.nulls(len(x), pa.int64()), none, none], names=names)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.nulls(1, pa.int64()), pa.array([int(y.sum())], pa.int64()), pa.array([int((y > 0).sum())], pa.int64()), pa.array([_squeeze(x)], pa.binary()), pa.array([_squeeze(y.astype(np.float64))], pa.binary())], names=names)

        for batch in batches:
            for shard, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if now is not None and shard != now:
                    yield from out()
                    keys, counts, held, base = [], [], 0, 0
                now = shard
                keys.append(_expand(k.as_py(), np.int64))
                counts.append(_expand(c.as_py(), np.int32).astype(np.int64))
                held += len(keys[-1])
                if held > max(1_000_000, 2 * base):
                    x, y = _added(keys, counts)
                    keys, counts, held, base = [x], [y], len(x), len(x)
        if keys:
            yield from out()

    return cut(map_arrow(requests.select("shard", "keys", "counts").repartition("shard").sortWithinPartitions("shard"), run, "shard int, key bigint, n bigint, v bigint, keys binary, counts binary"))


def _mask(order: int) -> int:
    return (1 << 8 * (order + 1)) - 1


def gram_values(counted: DataFrame) -> DataFrame:
    """(shard, key, value): log10 probability of every six-byte gram under the trie, from (shard, key, n)."""
    seen = counted.where("n > 0")
    edges = {ORDER: seen.select(F.col("key").alias("e"), "n")}
    for o in range(ORDER - 1, -1, -1):
        shorter = edges[o + 1].groupBy(F.col("e").bitwiseAND(_mask(o)).alias("e")).agg(F.sum("n").alias("n"))
        edges[o] = cut(shorter) if o in (ORDER - 1, ORDER - 3) else shorter
    stats = {}
    for o in range(ORDER, 0, -1):
        own = edges[o].select(F.shiftright("e", 8).alias("x"), "n", F.col("e").bitwiseAND(_mask(o - 1)).alias("parent"))
        up = edges[o - 1].select(F.col("e").alias("parent"), F.col("n").alias("up"))
        # T, D and what the context's symbols count in its suffix
        stats[o] = own.join(up, "parent").groupBy("x").agg(F.sum("n").alias(f"t{o}"), F.count("*").alias(f"d{o}"), F.sum("up").alias(f"u{o}"))
    root = edges[0].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count("*").alias("d")).first()
    stats[ORDER] = cut(stats[ORDER])

    with_top = counted.withColumn("x", F.shiftright("key", 8)).join(stats[ORDER], "x", "left").drop("x")
    known = with_top.where("n > 0").select("shard", "key", F.log10(F.col("n") / (F.col(f"t{ORDER}") + F.col(f"d{ORDER}"))).alias("value"))
    # keys that training lacks escape from their longest context, order by order; less_t and less_d are what is excluded
    t, d = F.col(f"t{ORDER}"), F.col(f"d{ORDER}")
    zero = F.lit(0).cast("bigint")
    rest = with_top.where("n = 0").select("shard", "key", F.coalesce(F.log10(d / (t + d)), F.lit(0.0)).alias("value"), F.lit(False).alias("done"), F.coalesce(f"u{ORDER}", zero).alias("less_t"), F.coalesce(d, zero).alias("less_d"))
    for o in range(ORDER - 1, -1, -1):
        few = o <= 1  # 256 to the power of o + 1 rows at most
        e = edges[o].select("e", F.col("n").alias("n"))
        rest = rest.withColumn("e", F.col("key").bitwiseAND(_mask(o))).join(F.broadcast(e) if few else e, "e", "left").drop("e")
        if o:
            s = stats[o].select("x", F.col(f"t{o}").alias("t"), F.col(f"d{o}").alias("d"), F.col(f"u{o}").alias("u"))
            rest = rest.withColumn("x", F.shiftright(F.col("key").bitwiseAND(_mask(o)), 8)).join(F.broadcast(s) if few else s, "x", "left").drop("x")
        else:
            rest = rest.withColumns({"t": F.lit(root.t), "d": F.lit(root.d), "u": zero})
        t, d = F.col("t") - F.col("less_t"), F.col("d") - F.col("less_d")
        step = F.when(F.col("n").isNotNull(), F.log10(F.col("n") / (t + d))).when(F.coalesce(d > 0, F.lit(False)), F.log10(d / (t + d))).otherwise(0.0)
        rest = rest.select("shard", "key", F.when(F.col("done"), F.col("value")).otherwise(F.col("value") + step).alias("value"), (F.col("done") | F.col("n").isNotNull()).alias("done"), F.coalesce("u", zero).alias("less_t"), F.coalesce("d", zero).alias("less_d"))
    last = F.when(F.col("done"), F.col("value")).otherwise(F.col("value") - F.log10(F.lit(float(SYMBOLS - root.d))))
    return known.unionByName(rest.select("shard", "key", last.alias("value")))


def _answers(requests: DataFrame, values: DataFrame) -> DataFrame:
    """(piece, shard, vals): a value for each key that a piece holds of a shard, in the keys' order.

    ``values`` has rows (shard, key, value) or blocks (shard, keys, counts).
    """
    none = F.lit(None)
    left = values.select("shard", F.lit(0).alias("turn"), none.cast("bigint").alias("piece"), "keys", "counts", "key", "value")
    right = requests.select("shard", F.lit(1).alias("turn"), "piece", "keys", none.cast("binary").alias("counts"), none.cast("bigint").alias("key"), none.cast("double").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, vals, table = None, [], [], None
        for batch in batches:
            shard, turn = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(shard, prepend=-1) != 0) | (np.diff(turn, prepend=-1) != 0))
            for a, b in zip(cuts, np.append(cuts[1:], len(shard))):
                if shard[a] != now:
                    now, keys, vals, table = shard[a], [], [], None
                if turn[a] == 0 and now % 2 == GRAMS:
                    keys.append(batch.column(5).slice(a, b - a).to_numpy())
                    vals.append(batch.column(6).slice(a, b - a).to_numpy())
                    continue
                if turn[a] == 0:
                    keys += [_expand(batch.column(3)[int(i)].as_py(), np.int64) for i in range(a, b)]
                    vals += [_expand(batch.column(4)[int(i)].as_py(), np.float64) for i in range(a, b)]
                    continue
                if table is None:
                    k, v = np.concatenate(keys), np.concatenate(vals)
                    order = np.argsort(k)
                    table, keys, vals = (k[order], v[order].astype(np.float32 if now % 2 == GRAMS else np.float64)), [], []
                got = [_squeeze(table[1][np.searchsorted(table[0], _expand(batch.column(3)[int(i)].as_py(), np.int64))]) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(a, b - a), pa.array(np.full(b - a, now, np.int32)), pa.array(got, pa.binary())], names=["piece", "shard", "vals"])

    return map_arrow(left.unionByName(right).repartition("shard").sortWithinPartitions("shard", "turn"), run, "piece bigint, shard int, vals binary")


class _Lookup:
    """Values of sorted keys: a direct table by hash, and a search for what collides."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = np.uint64(64 - max(8, int(len(keys) * 4).bit_length()))
        self.slot = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slot[self._place(keys)] = np.arange(len(keys), dtype=np.int32)

    def _place(self, x: np.ndarray) -> np.ndarray:
        return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, want: np.ndarray) -> np.ndarray:
        at = self.slot[self._place(want)]
        miss = np.flatnonzero(self.keys[at] != want)
        at[miss] = np.searchsorted(self.keys, want[miss])
        return self.values[at]


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte: one row per input row."""
    spark = docs.sparkSession
    packed = _pack(docs, learn, key, text, piece_bytes)
    shards = max(12, packed.count())
    requests = _requests(packed, shards)
    counted = _merged(requests)
    unigram = counted.where("shard % 2 = 1")
    total = unigram.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    none = F.lit(None).cast("binary")
    values = gram_values(counted.where("shard % 2 = 0").select("shard", "key", "n")).select("shard", "key", "value", none.alias("keys"), none.alias("counts"))
    values = values.unionByName(unigram.select("shard", "key", F.lit(None).cast("double").alias("value"), "keys", "counts"))
    answers = _answers(requests, values)
    n_train, floor = int(total.n), float(total.n) + float(total.v) + 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = _unpack(left.column("rows")[0].as_py())
        raw, off = utf8(rows.column(1))
        n = rows.num_rows
        got = dict(zip(right.column("shard").to_pylist(), right.column("vals")))
        out = {k: np.zeros(n) for k in ("tokens", "known", "base", "model")}
        for kind, split in ((GRAMS, grams), (WORDS, words)):
            key, _ = _counted(split, raw, off, np.zeros(n, bool))
            value = np.zeros(len(key))
            for shard, places in _split(key, kind, shards):
                value[places] = _expand(got[shard].as_py(), np.float32 if kind == GRAMS else np.float64)
            find = _Lookup(key, value)
            for a, b in _steps(raw, off):
                want, row = split(raw[off[a] : off[b]], off[a : b + 1] - off[a])
                x, m = find(want), b - a
                if kind == GRAMS:
                    out["model"][a:b] = np.bincount(row, weights=x, minlength=m)
                else:
                    out["tokens"][a:b] = np.bincount(row, minlength=m)
                    out["known"][a:b] = np.bincount(row[x > 0], minlength=m)
                    out["base"][a:b] = np.bincount(row, weights=np.log10((x + 1) / floor), minlength=m)
        size = np.diff(off)
        bits = -out["model"] / np.log10(2) / np.maximum(size, 1)
        cols = [rows.column(0), out["tokens"].astype(np.int64), out["known"].astype(np.int64), np.full(n, n_train, np.int64), out["base"], out["model"], size, bits]
        return pa.Table.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"
    return packed.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(run, schema)
