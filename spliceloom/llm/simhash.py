"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a
document's shingles.  Two fingerprints link at ``radius`` = 2 or fewer differing
bits.  Every bit position gets a non-zero vector of three bits; for each of the
seven non-zero v, table v keeps the bits whose vector m has <m, v> = 0.  Any two
positions have a common v, so any pair within the radius agrees on some table's
key: no pair is missed.

Inside one bucket pairs are not compared: members differ only in the positions
that the table leaves out, and two are within two bits exactly if they meet in a
point one bit away from both (or are one bit apart).  So each member is filed
under itself and its one-bit neighbours and linked to the smallest member of
each file: linear in the bucket, and no wrong or lost link.  Buckets above
``max_bucket`` are divided by the same seven masks over the left-out positions,
again without loss, until none is.

Defined results: null or empty text, or no words, has fingerprint 0 and links
like any other; long texts are taken whole; equal fingerprints (ties) are one
class; repeated rows each return a row; a null doc_id keeps its row and never
names a component unless all ids of it are null; an empty table is empty; other
columns may have any name, and ``keep_one`` returns them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_sets
from .common import cut, keep_rows, keyed, map_arrow, map_text, utf8
from .graph import components
from .shingles import majority, shingle_hashes

RADIUS = 2
BITS = 64
EVERY = (1 << BITS) - 1
TABLES = 7
#: Distinct fingerprints of one bucket that a task takes at once (some 40 filings of 60 bytes each).
MAX_BUCKET = 1 << 15
#: Buckets are not divided below this: division ends at four left-out bits or fewer, and no bucket is larger then.
LEAST_BUCKET = 16


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its 64-bit fingerprint ``fp`` (as a signed long), one row per input row."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw, off = utf8(batch.column(1))
            data, out = raw.tobytes(), np.zeros(batch.num_rows, np.uint64)
            held: list[np.ndarray] = []
            rows: list[int] = []
            size = 0

            def flush() -> None:
                if held:
                    out[rows] = majority(held)
                    held.clear(), rows.clear()

            for i in range(batch.num_rows):
                got = shingle_hashes(data[off[i] : off[i + 1]], shingle, seed)
                if len(got):
                    held.append(got), rows.append(i)
                    size += len(got)
                if size > 200_000:
                    flush()
                    size = 0
            flush()
            return {"doc_id": batch.column(0), "fp": out.view(np.int64)}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, fp bigint", make)


def masks(left_out: int = EVERY) -> list[int]:
    """The seven masks of kept bits among ``left_out``; bits outside it are kept by all."""
    free = [i for i in range(BITS) if left_out >> i & 1]
    vector = {p: k % TABLES + 1 for k, p in enumerate(free)}
    return [EVERY & ~sum(1 << p for p in free if bin(vector[p] & v).count("1") % 2) for v in range(1, TABLES + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def star_links(fp: np.ndarray, group: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets: ``group`` ids the bucket of each fingerprint, ``kept`` its table's mask.

    Returns (fingerprint, smaller fingerprint) pairs, linear in the number of members.
    """
    order = np.lexsort((fp, group))
    fp, group, kept = fp[order], group[order], kept[order]
    same = np.zeros(len(fp), bool)
    same[1:] = group[1:] == group[:-1]
    crowd = same.copy()
    crowd[:-1] |= same[1:]
    fp, group, kept = fp[crowd], group[crowd], kept[crowd]
    ends: list[np.ndarray] = []
    for table in np.unique(kept):
        mine = kept == table
        a, g = fp[mine], group[mine]
        _, g = np.unique(g, return_inverse=True)
        flips = [0] + [1 << i for i in range(BITS) if not int(table) >> i & 1]
        # 2**20 filings or so at a time, or one bucket
        edges = np.flatnonzero(np.diff(g, prepend=-1))
        step = max(1, (1 << 20) // len(flips))
        lo = 0
        while lo < len(a):
            hi = int(edges[np.searchsorted(edges, lo + step)]) if lo + step < len(a) and np.searchsorted(edges, lo + step) < len(edges) else len(a)
            x, gg = a[lo:hi], g[lo:hi]
            point = (x[:, None] ^ np.array(flips, np.uint64)[None, :]).ravel()
            who = np.repeat(np.arange(len(x)), len(flips))
            o = np.lexsort((who, point, gg[who]))
            point, who = point[o], who[o]
            new = np.ones(len(o), bool)
            new[1:] = (point[1:] != point[:-1]) | (gg[who[1:]] != gg[who[:-1]])
            head = who[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
            pair = np.unique(who[~new] * np.int64(len(x)) + head[~new])
            ends.append(np.stack([x[pair // len(x)], x[pair % len(x)]]) if len(pair) else np.zeros((2, 0), np.uint64))
            lo = hi
    both = np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.uint64)
    return both[0], both[1]


def links(fps: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b), a != b, over distinct fingerprints ``fp`` that connect exactly what radius 2 connects."""
    whole = fps.select(F.lit(0).cast("long").alias("kept"), "fp")
    level = _filed(whole, [0])
    out = None
    while True:
        hot = cut(level.groupBy("kept", "bucket").count().where(F.col("count") > max(max_bucket, LEAST_BUCKET)).select("kept", "bucket"))
        tables = [r.kept for r in hot.select("kept").distinct().collect()]  # at most 7 to the level's power
        found = _in_buckets(level.join(hot, ["kept", "bucket"], "left_anti") if tables else level)
        out = found if out is None else out.unionByName(found)
        if not tables:
            return out
        level = cut(_filed(level.join(hot, ["kept", "bucket"], "left_semi").select("kept", "fp"), tables).distinct())


def _filed(fps: DataFrame, tables: list[int]) -> DataFrame:
    """Each (kept, fp) once under each of the seven masks that divide what its table leaves out: kept (the mask, signed), bucket, fp."""
    masks_of = [(k, _signed(m)) for k in tables for m in masks(~k & EVERY)]
    if len(tables) == 1:
        finer = fps.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for _, m in masks_of])).alias("kept"))
    else:
        to = fps.sparkSession.createDataFrame(masks_of, "kept long, finer long")
        finer = fps.join(F.broadcast(to), "kept").select("fp", F.col("finer").alias("kept"))
    return finer.select("kept", F.col("fp").bitwiseAND(F.col("kept")).alias("bucket"), "fp")


def _in_buckets(filed: DataFrame) -> DataFrame:
    """Links inside the buckets; a task reads whole buckets, sorted, and holds one at a time at most beyond a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def links_of(x: np.ndarray) -> pa.RecordBatch:
            change = np.ones(x.shape[1], bool)
            change[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
            a, b = star_links(x[2].view(np.uint64), np.cumsum(change), x[0].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            rows += batch.num_rows
            if rows > 100_000:
                x = np.ascontiguousarray(np.concatenate(held, axis=1))
                last = np.flatnonzero((x[0] != x[0, -1]) | (x[1] != x[1, -1]))
                whole = int(last[-1]) + 1 if len(last) else 0
                if whole:
                    yield links_of(np.ascontiguousarray(x[:, :whole]))
                held, rows = [x[:, whole:]], x.shape[1] - whole
        if held and rows:
            yield links_of(np.ascontiguousarray(np.concatenate(held, axis=1)))

    return map_arrow(filed.repartition("kept", "bucket").sortWithinPartitions("kept", "bucket"), run, "a bigint, b bigint")


def classes(fps: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(fp, component_id, root) for every distinct ``fp`` of (doc_id, fp): the smallest doc_id reachable."""
    own = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    root = components(links(own, max_bucket))
    member = own.join(root, own.fp == root.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    best = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return member.join(best, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id: one row per input row."""
    fps = cut(fingerprints(docs, shingle, seed, key, text))
    return fps.join(classes(fps), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id.

    Documents link where their fingerprints (here of five-word shingles) are within
    the radius, and, as few fingerprints of edited copies are, also where their sets
    of shingles have a Jaccard similarity of ``similarity`` or more (``near_sets``).
    Of rows with one id but different texts the one with the smallest text hash
    stands for the id; a row with a null id stays only where its whole group has no
    other; see ``common.keep_rows`` for rows equal in both.
    """
    rows = cut(near_sets.sketches(docs, shingle, seed, key, text))
    own = cut(rows.groupBy("h").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "th")).alias("first"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    head = own.groupBy("fp").agg(F.min("h").alias("head"))
    alike = own.join(head, "fp").select(F.col("h").alias("a"), F.col("head").alias("b"))
    near = cut(links(head.select("fp")))
    across = near.join(head.toDF("a", "x"), "a").join(head.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    pair = cut(rows.groupBy("doc_id", "th").agg(F.count("*").alias("rows")).select(F.col("doc_id").alias("id"), "th", (F.col("rows") > 1).alias("many")))
    repeated = not pair.where("many").isEmpty()
    root = components(alike.unionByName(across).unionByName(near_sets.links(docs, own, similarity, shingle, seed, key, text, repeated)))
    member = own.join(root, own.h == root.node, "left").select("h", "first", F.coalesce("root", "h").alias("root"))
    stay = member.groupBy("root").agg(F.min("first").alias("first"))
    first = stay.select(F.col("first.id").alias("stay_id"), F.col("first.th").alias("stay_th"))
    judged = pair.join(first, pair["id"].eqNullSafe(first["stay_id"]) & (pair["th"] == first["stay_th"]), "left")
    return keep_rows(docs, cut(judged.select("id", "th", "many", F.col("stay_th").isNotNull().alias("stays"))), key, text)
