"""Benchmark decontamination with suffix arrays of the training text.

Documents are read in shards of bounded size.  A shard's words become numbers of
the test items' vocabulary (0: a word that no item holds; no match crosses it or
a document's end).  Positions in runs shorter than the shortest window cannot
match and are left out; the rest are ordered by prefix doubling, up to the
longest item: the shard's suffix array.  Every test suffix is binary-searched in
it, word after word, which gives its longest verbatim match and, at window
length, all places where the window occurs.  Words of hits are compared byte by
byte, so a hash collision cannot make a hit.

Items come in blocks of bounded size, each one broadcast.  A task holds one
shard and one block at a time and goes through the blocks for every shard, so
neither its memory nor the plan grows with the number of items.

Defined results: null and empty texts have no words; an item of fewer than
``window`` words is one window, one of none has no window; long texts are one
shard of their own; items with equal windows (ties) are all named; repeated rows
and ids return their own rows; a document is hit by an item once however often it
occurs; without items, or with an empty table, nothing is hit; other columns may
have any name and ``decontaminate`` returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, ascii_lower, filter_text, keyed, map_text, named, utf8, word_bounds, word_hash

WINDOW = 10
#: UTF-8 bytes of one block of items; a longer item alone is a block.
BLOCK_BYTES = 8 << 20
#: Bytes of a shard at most: as many as the items have, within CHUNK_BYTES and this.
MOST_SHARD_BYTES = 12 << 20


def _word_bytes() -> np.ndarray:
    """Which bytes (after lower-casing) belong to words: 0-9, a-z and all of 0x80 and above."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


class Items:
    """Test items as word numbers, their windows, and the vocabulary to number words with."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW):
        self.window = window
        raw, off = utf8(pa.array(texts, pa.string()))
        low = ascii_lower()[raw]
        s, e = word_bounds(_word_bytes()[low], off)
        h = word_hash(low, s, e)
        self.hashes, first, self.words = np.unique(h, return_index=True, return_inverse=True)
        self.words = self.words.astype(np.int64) + 1
        size = e[first] - s[first]
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.spelled = low[np.arange(int(self.at[-1])) + np.repeat(s[first] - self.at[:-1], size)].tobytes()
        self.ids = [str(x) for x in ids]
        cut_at = np.searchsorted(s, off)
        count = np.diff(cut_at)
        self.item = np.repeat(np.arange(len(ids)), count)
        self.left = np.repeat(cut_at[1:], count) - np.arange(len(s))  # words to the item's end
        length = np.minimum(count, window)[self.item]
        place = np.arange(len(s)) - np.repeat(cut_at[:-1], count)
        self.length = np.where((self.left >= length) & ((count[self.item] >= window) | (place == 0)), length, 0)  # 0: no window starts here
        self.shortest = int(length.min()) if len(length) else 0
        self.longest = int(count.max()) if len(count) else 0

    def number(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 1, 0).astype(np.int64)


def suffix_array(words: np.ndarray, run_end: np.ndarray, shortest: int, depth: int) -> np.ndarray:
    """Positions of runs of at least ``shortest`` words, ordered by their first ``depth`` words.

    ``words`` are numbers, 0 ending a run; run_end[i] is the end of i's run (i where words[i] is 0).
    """
    n = len(words)
    start = np.ones(n, bool)
    start[1:] = run_end[1:] != run_end[:-1]
    begin = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    at = np.flatnonzero((words > 0) & (run_end - begin >= shortest))
    if not len(at):
        return at
    rank = np.zeros(n + 1, np.int64)
    rank[at] = words[at]
    step = 1
    while True:
        nxt = np.where(at + step < run_end[at], rank[np.minimum(at + step, n)], 0)
        pair = rank[at].astype(np.uint64) * np.uint64(n + int(words.max()) + 2) + nxt.astype(np.uint64)
        order = np.argsort(pair, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = pair[order][1:] != pair[order][:-1]
        step *= 2
        if step >= depth or new.all():
            return at[order]
        rank[at[order]] = np.cumsum(new)


def search(words: np.ndarray, run_end: np.ndarray, array: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Binary search of every test suffix: its longest match in words and that match's interval of the
    array, and the interval of its window, empty where no window starts or it does not occur.  Last, rows of
    start, end and depth: parts of the windows' intervals that match so many words and no more.
    """
    m, n = len(items.words), len(array)
    lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
    longest = np.zeros(m, np.int64)
    first, last = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.arange(m) if n else np.zeros(0, np.int64)
    padded = np.append(words, 0)
    dropped = [np.zeros((0, 3), np.int64)]
    depth = 0
    while len(live):
        want = items.words[live + depth]

        def bound(a: np.ndarray, b: np.ndarray, right: bool) -> np.ndarray:
            a, b = a.copy(), b.copy()
            while True:
                open_ = a < b
                if not open_.any():
                    return a
                mid = (a + b) >> 1
                p = array[np.minimum(mid, n - 1)] + depth
                have = np.where(p < run_end[np.minimum(array[np.minimum(mid, n - 1)], len(run_end) - 1)], padded[np.minimum(p, len(words))], 0)
                below = (have <= want) if right else (have < want)
                a = np.where(open_ & below, mid + 1, a)
                b = np.where(open_ & ~below, mid, b)

        l0 = bound(lo[live], hi[live], False)
        h0 = bound(l0, hi[live], True)
        found = h0 > l0
        live = live[found]
        l0, h0 = l0[found], h0[found]
        for a, b in ((lo[live], l0), (h0, hi[live])):
            out = (last[live] > first[live]) & (b > a)
            dropped.append(np.unique(np.stack([a[out], b[out], np.full(int(out.sum()), depth)], axis=1), axis=0))
        lo[live], hi[live] = l0, h0
        depth += 1
        longest[live] = depth
        ends = live[items.length[live] == depth]
        first[ends], last[ends] = lo[ends], hi[ends]
        live = live[items.left[live] > depth]
    return longest, lo, hi, first, last, np.concatenate(dropped)


def scan_shard(raw: np.ndarray, off: np.ndarray, items: Items) -> dict:
    """Word counts, hit-word counts, hit items and longest match of each row of one shard."""
    low = ascii_lower()[raw]
    s, e = word_bounds(_word_bytes()[low], off)
    doc_at = np.searchsorted(s, off)
    rows = len(off) - 1
    out = {"n_words": np.diff(doc_at), "n_hit": np.zeros(rows, np.int64), "items": [[] for _ in range(rows)], "longest": np.zeros(rows, np.int64), "spans": [[] for _ in range(rows)]}
    if not len(s) or not len(items.words):
        return out
    words = items.number(word_hash(low, s, e))
    doc = np.repeat(np.arange(rows), out["n_words"])
    while True:
        n = len(words)
        stop = np.ones(n, bool)  # a run ends before each unknown word and each document
        stop[1:] = (words[1:] == 0) | (words[:-1] == 0) | (doc[1:] != doc[:-1])
        edges = np.append(np.flatnonzero(stop), n)
        run_end = np.repeat(edges[1:], np.diff(edges))
        run_end = np.where(words == 0, np.arange(n), run_end)
        array = suffix_array(words, run_end, items.shortest, items.longest)
        longest, lo, hi, first, last, dropped = search(words, run_end, array, items)
        has = np.flatnonzero(last > first)
        # each interval once for the hits, however many items share the window
        key, one = np.unique(first[has] * (len(array) + 1) + items.length[has], return_index=True)
        mark = np.zeros(n + 1, np.int64)
        for w in has[one]:
            p = array[first[w] : last[w]]
            np.add.at(mark, p, 1)
            np.add.at(mark, p + items.length[w], -1)
        hit = np.cumsum(mark[:n]) > 0
        wrong = [i for i in np.flatnonzero(hit) if low[s[i] : e[i]].tobytes() != items.spelled[items.at[words[i] - 1] : items.at[words[i]]]]
        if not wrong:
            break
        words[wrong] = 0
    out["n_hit"] = np.bincount(doc[hit], minlength=rows)
    pairs = [np.zeros(0, np.int64)]
    docs_of: dict[tuple[int, int], np.ndarray] = {}
    for w in has:
        at = (int(first[w]), int(last[w]))
        if at not in docs_of:
            docs_of[at] = np.unique(doc[array[at[0] : at[1]]])
        pairs.append(docs_of[at] * len(items.ids) + items.item[w])
    for p in np.unique(np.concatenate(pairs)):
        out["items"][p // len(items.ids)].append(items.ids[p % len(items.ids)])
    for w in has:
        np.maximum.at(out["longest"], docs_of[int(first[w]), int(last[w])], items.length[w])
        np.maximum.at(out["longest"], doc[array[lo[w] : hi[w]]], longest[w])
    for a, b, depth in dropped:
        np.maximum.at(out["longest"], doc[array[a:b]], depth)
    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    # spans of hit words, as byte offsets into the row; a run of hits is cut at document ends
    for a, b in zip(turn[::2], turn[1::2]):
        for d in range(doc[a], doc[b - 1] + 1):
            i, j = max(a, doc_at[d]), min(b, doc_at[d + 1])
            if i < j:
                out["spans"][d].append((int(s[i] - off[d]), int(e[j - 1] - off[d])))
    return out


class Blocks:
    """Broadcast blocks of items, of which a task holds one at a time."""

    def __init__(self, bench: DataFrame, window: int, item_key: str, item_text: str, block_bytes: int):
        sc = bench.sparkSession.sparkContext
        self.boxes, self.bytes = [], 0
        for ids, texts in _blocks(bench.select(named(item_key), named(item_text)), block_bytes):
            self.bytes = max(self.bytes, sum(len(t or "") for t in texts))
            self.boxes.append(sc.broadcast(Items(ids, texts, window)))

    def __iter__(self):
        for box in self.boxes:
            yield box.value
            if len(self.boxes) > 1:
                box.__dict__.pop("_value", None)  # it is read again from the executor's copy

    @property
    def shard_bytes(self) -> int:
        """More items are worth larger shards, as each is searched for in every shard."""
        return min(MOST_SHARD_BYTES, max(CHUNK_BYTES, self.bytes))


def scan_blocks(raw: np.ndarray, off: np.ndarray, blocks) -> dict:
    """``scan_shard`` over all blocks of items: hits are united."""
    out = None
    for items in blocks:
        got = scan_shard(raw, off, items)
        if out is None:
            out, many = got, False
            continue
        many = True
        out["longest"] = np.maximum(out["longest"], got["longest"])
        out["items"] = [a + b for a, b in zip(out["items"], got["items"])]
        out["spans"] = [a + b for a, b in zip(out["spans"], got["spans"])]
    if many:
        keep, low = _word_bytes(), ascii_lower()
        for i, spans in enumerate(out["spans"]):
            if spans:
                s, e = word_bounds(keep[low[raw[off[i] : off[i + 1]]]], np.array([0, off[i + 1] - off[i]]))
                step = np.zeros(len(s) + 1, np.int64)
                for k, side in ((0, 1), (1, -1)):  # hit words, whichever blocks hit them
                    np.add.at(step, np.searchsorted(s, [x[k] for x in spans]), side)
                hit = np.cumsum(step[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                out["n_hit"][i] = hit.sum()
                out["spans"][i] = [(int(s[a]), int(e[b - 1])) for a, b in zip(turn[::2], turn[1::2])]
    return out


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, hit_items (array), longest (verbatim match of an item with
    an occurring window, in words), spans (array: start and end byte of each run of hits)."""
    blocks = Blocks(bench, window, item_key, item_text, block_bytes)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            got = scan_blocks(*utf8(batch.column(1)), blocks)
            hit_items, spans = [sorted(set(x)) for x in got["items"]], [[x for s in row for x in s] for row in got["spans"]]
            return {"doc_id": batch.column(0), "n_words": got["n_words"].astype(np.int64), "n_hit": got["n_hit"].astype(np.int64), "hit_items": pa.array(hit_items, pa.list_(pa.string())), "longest": got["longest"].astype(np.int64), "spans": pa.array(spans, pa.list_(pa.int64()))}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, n_words bigint, n_hit bigint, hit_items array<string>, longest bigint, spans array<bigint>", make, blocks.shard_bytes)


def _blocks(bench: DataFrame, most: int):
    """Ids and texts of the items in blocks, read to the driver one row at a time; at least one block."""
    ids, texts, size, any_ = [], [], 0, False
    for item, text in bench.toLocalIterator():
        n = len((text or "").encode())
        if ids and size + n > most:
            yield ids, texts
            ids, texts, size, any_ = [], [], 0, True
        ids.append(item), texts.append(text)
        size += n
    if ids or not any_:
        yield ids, texts


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``matches``."""
    joined = F.array_join(F.sort_array("hit_items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"), F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, text: str = "text", item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold an item's window; one pass without a shuffle."""
    blocks = Blocks(bench, window, item_key, item_text, block_bytes)

    def make():
        def keep(column: pa.Array) -> np.ndarray:
            raw, off = utf8(column)
            return np.logical_and.reduce([scan_shard(raw, off, items)["n_hit"] == 0 for items in blocks])

        return keep

    return filter_text(docs, text, make, blocks.shard_bytes)
