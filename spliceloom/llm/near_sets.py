"""Links between near copies by the exact Jaccard similarity of word-shingle sets.

This is the part of the near-copy stage that fingerprints cannot give: at a similarity of 0.8 fingerprints of 64 bits
differ in some 10 bits, for which covering masks would take 2**11 - 1 tables and more.

Candidates come from min-wise hashing: a set has ``BANDS`` keys, each made of ``ROWS`` minima, and two sets of
similarity s share a key with probability 1 - (1 - s**ROWS)**BANDS (over 0.9999 at 0.8).  Every candidate pair is then
held against the sets themselves, so that no wrong link stays.

Equal sets are one set.  In a bucket (the sets with one key) of up to ``SMALL`` sets all pairs are candidates.  Larger
buckets are not paired off: each set meets the first of the bucket and its next two by size.  Where that leaves the
members of overlapping large buckets in more than one component, they are dealt into blocks of about ``BLOCK`` shingles,
and each pair of blocks goes to a task that holds sets of different components against each other, those first whose
minima agree on at least ``LEAST`` of the draws; it returns a forest of links, never all pairs.

Defined results: null and empty texts, or texts without words, have the empty set, which is one set; a text of fewer
words than a shingle is one shingle; long texts are taken whole; repeated rows have one set; an empty table has no
links; other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, if_small, keyed, map_arrow, map_text, mixed, text_hash, utf8
from .graph import components
from .shingles import majority, shingle_hashes

BANDS, ROWS = 24, 5
SMALL = 16
BLOCK = 500_000
#: Of 120 draws, sets of similarity 0.8 agree on 0.8 +- 0.037.
LEAST = 0.66
_DRAW = np.random.default_rng(7)
_FLIP = _DRAW.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_TIMES = _DRAW.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def set_hash(s: np.ndarray) -> int:
    """Name of a set, as a signed long."""
    return int(np.array(xxhash.xxh64_intdigest(s.tobytes()), np.uint64).view(np.int64))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BANDS`` keys for each set, none of them empty."""
    size = np.array([len(s) for s in sets])
    at = np.cumsum(size) - size
    low = np.concatenate(sets).astype(np.uint32)
    out = np.zeros((len(sets), BANDS), np.uint64)
    for j in range(BANDS):
        key = np.full(len(sets), j + 1, np.uint64)
        for k in range(j * ROWS, (j + 1) * ROWS):
            key = mixed(key ^ np.minimum.reduceat((low ^ _FLIP[k]) * _TIMES[k], at).astype(np.uint64)) + np.uint64(k)
        out[:, j] = key
    return out.view(np.int64)


def sketches(docs: DataFrame, shingle: int, seed: int, key: str, text: str) -> DataFrame:
    """doc_id, th (hash of the text), h (name of the set), n (its size), fp (fingerprint) and the set's keys, one row per input row."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw, off = utf8(batch.column(1))
            data, rows = raw.tobytes(), batch.num_rows
            h, n, fp = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.uint64)
            keys: list = [[]] * rows
            lists: list[np.ndarray] = []
            held: list[np.ndarray] = []
            who: list[int] = []
            few = 0

            def flush() -> None:
                if held:
                    fp[who] = majority(lists)
                    for i, k in zip(who, band_keys(held)):
                        keys[i] = k
                    lists.clear(), held.clear(), who.clear()

            for i in range(rows):
                every = shingle_hashes(data[off[i] : off[i + 1]], shingle, seed)
                s = np.unique(every)
                h[i], n[i] = set_hash(s), len(s)
                if len(s):
                    lists.append(every), held.append(s), who.append(i)
                    few += len(every)
                if few > 100_000:
                    flush()
                    few = 0
            flush()
            return {"doc_id": batch.column(0), "th": batch.column(2), "h": h, "n": n, "fp": fp.view(np.int64), "keys": pa.array(keys, pa.list_(pa.int64()))}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text, text_hash(text).alias("th")), f"doc_id {kind}, th bigint, h bigint, n bigint, fp bigint, keys array<bigint>", make)


def near_pairs(key: np.ndarray, n: np.ndarray, h: np.ndarray, similarity: float, going_on: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (larger h, smaller h) of buckets in order of key and size; rows of large buckets and the first of their bucket.

    ``going_on``: the first bucket is the rest of a large one, after its first row and its last two so far.
    """
    begin = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    count = np.diff(np.append(begin, len(key)))
    first, many = np.repeat(begin, count), np.repeat(count, count)
    big = many > SMALL
    big[first == 0] |= going_on
    row = np.arange(len(key))
    left, right = [], []
    for d in range(1, SMALL):
        i = row[:-d] if d < 3 else row[:-d][~big[:-d]]
        i = i[first[i] == first[i + d]]
        left.append(i), right.append(i + d)
    i = row[big & (row > first)]
    left.append(first[i]), right.append(i)
    a, b = np.concatenate(left), np.concatenate(right)
    fits = (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b])) & (h[a] != h[b])
    x, y = h[a[fits]], h[b[fits]]
    return np.maximum(x, y), np.minimum(x, y), h[big], h[first[big]]


def candidates(filed: DataFrame, similarity: float, most: int = 100_000) -> DataFrame:
    """(a, b, big) from (key, n, h): candidate pairs, and (set, a set of its bucket) for the sets in large buckets where ``big``.

    A task holds some ``most`` rows at a time: of a longer bucket, its first row and its last two are carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows, going_on = 0, False

        def out(x: np.ndarray) -> pa.RecordBatch:
            a, b, many, first = near_pairs(x[0], x[1], x[2], similarity, going_on)
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            mark = np.arange(len(pairs) + len(many)) >= len(pairs)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([pairs[:, 0], many])), pa.array(np.concatenate([pairs[:, 1], first])), pa.array(mark)], names=["a", "b", "big"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            rows += batch.num_rows
            if rows > most:
                x = np.concatenate(held, axis=1)
                whole = int(np.searchsorted(x[0], x[0, -1]))
                if whole:
                    yield out(x[:, :whole])
                    x, going_on = x[:, whole:], False
                if x.shape[1] > max(most // 2, SMALL):
                    yield out(x)
                    x, going_on = x[:, [0, -2, -1]], True
                held, rows = [x], x.shape[1]
        if rows:
            yield out(np.concatenate(held, axis=1))

    return map_arrow(filed.select("key", "n", "h").repartition("key").sortWithinPartitions("key", "n", "h"), run, "a bigint, b bigint, big boolean")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k)] for k in (2, 3))
            same = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)], np.int64)
            total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64) - same
            yield batch.select([0, 1]).filter(pa.array(same >= similarity * total, pa.bool_()))

    return map_arrow(pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y"), run, "a bigint, b bigint")


def member_sets(docs: DataFrame, first: DataFrame, shingle: int, seed: int, key: str, text: str, repeated: bool) -> DataFrame:
    """(h, set) of the documents ``first`` (id, th), each set once; ``repeated``: an id may have a text in several rows."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw, off = utf8(batch.column(1))
            data = raw.tobytes()
            sets = [np.unique(shingle_hashes(data[off[i] : off[i + 1]], shingle, seed)) for i in range(batch.num_rows)]
            return {"h": np.array([set_hash(s) for s in sets], np.int64), "set": pa.array([s.tobytes() for s in sets], pa.binary())}

        return work

    mine, to = docs.select(*keyed(docs, key, text, text_hash(text).alias("th"))), first.toDF("to_id", "to_th")
    found = mine.join(if_small(to), mine["doc_id"].eqNullSafe(to["to_id"]) & (mine["th"] == to["to_th"]), "left_semi")
    sets = map_text(found, ["doc_id", "text"], "h bigint, set binary", make)
    return sets.dropDuplicates(["h"]) if repeated else sets


def links(docs: DataFrame, own: DataFrame, similarity: float, shingle: int, seed: int, key: str, text: str, repeated: bool) -> DataFrame:
    """Verified links (a, b) over the distinct sets ``own`` (h, first: struct of id and th, n, keys)."""
    found = cut(candidates(own.select(F.explode("keys").alias("key"), "n", "h"), similarity))
    nodes = found.select(F.col("a").alias("h")).unionByName(found.where("not big").select(F.col("b").alias("h"))).distinct()
    first = cut(own.join(nodes, "h", "left_semi").select("first.id", "first.th"))
    sets = cut(member_sets(docs, first, shingle, seed, key, text, repeated))
    out = cut(verified(found.where("not big").select("a", "b").distinct(), sets, similarity))
    big = found.where("big").select("a", "b")
    if big.isEmpty():
        return out
    group = components(big).select(F.col("node").alias("h"), F.col("root").alias("g"))
    root = components(out)
    member = group.join(root, group.h == root.node, "left").select("h", "g", F.coalesce("root", "h").alias("label")).join(own.select("h", "n"), "h")
    size = member.groupBy("g").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("g", "blocks")
    mine = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    dealt = member.join(size, "g").select("g", "label", "h", mine.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("g", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "label", "h").join(sets, "h")
    return out.unionByName(cut(across(dealt, similarity)))


def across(dealt: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between different labels among the sets of each (g, lo, hi): a forest, by exact similarity."""
    where = ["g", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            h, label, block = (t.column(k).to_numpy() for k in ("h", "label", "own"))
            pairs = forest([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set")], label, block, now[1] == now[2], similarity)
            return pa.RecordBatch.from_arrays([pa.array([h[i] for i, _ in pairs], pa.int64()), pa.array([h[j] for _, j in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            at = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            begin = np.append(np.flatnonzero(np.append(True, (at[:, 1:] != at[:, :-1]).any(axis=0))), batch.num_rows)
            for lo, hi in zip(begin, begin[1:]):
                if lo == hi:
                    continue
                if held and tuple(at[:, lo]) != now:
                    yield out()
                    held = []
                now = tuple(at[:, lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield out()

    return map_arrow(dealt.select(*where, "own", "label", "h", "set").repartition(*where).sortWithinPartitions(*where), run, "a bigint, b bigint")


def forest(sets: list[np.ndarray], label: np.ndarray, block: np.ndarray, inside: bool, similarity: float) -> list[tuple[int, int]]:
    """Positions of similar sets that join different labels; pairs of one block only where ``inside``."""
    size = np.array([len(s) for s in sets])
    at = np.cumsum(size) - size
    low = np.concatenate(sets).astype(np.uint32)
    drawn = np.stack([np.minimum.reduceat((low ^ f) * t, at) >> np.uint32(24) ^ np.minimum.reduceat((low ^ f) * t, at) & np.uint32(255) for f, t in zip(_FLIP, _TIMES)], axis=1).astype(np.uint8)
    label, out = label.copy(), []
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        j = j[(label[j] != label[i]) & (np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i])) & (inside | (block[j] != block[i]))]
        agree = (drawn[j] == drawn[i]).sum(axis=1)
        order = np.argsort(-agree, kind="stable")
        for k in j[order[: int((agree >= LEAST * drawn.shape[1]).sum())]].tolist():
            if label[k] == label[i]:
                continue
            same = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if same >= similarity * (size[i] + size[k] - same):
                out.append((i, k))
                label[label == label[k]] = label[i]
    return out
