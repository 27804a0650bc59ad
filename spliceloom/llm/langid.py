"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts come from all labelled rows; each task adds up one count vector
per language, and the vectors are summed by language.  The log-probability matrix
(languages x buckets, float32) is what is broadcast: its size is fixed by
``BUCKETS`` and at most ``MAX_LANGS`` languages (more is an error).  A batch of
whole texts is scored at once in numpy from its sparse bucket numbers.

Characters are lower-cased, and all but letters become one blank.

Defined results: null text, or text with no letter, is ``und`` with score 0; rows
without a language teach nothing; long texts are taken whole, some of their bytes
at a time; ties take the language that sorts first; repeated rows teach and return
each time; no training rows at all make every row ``und``; an empty table is
empty; other columns may have any name, and ``keep_known`` returns them as they
are.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_text, keyed, map_arrow, map_text, named, pieces, utf8

#: UTF-8 bytes whose n-grams are held at once.
STEP_BYTES = 1 << 19
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGS = 256
UND = "und"


@functools.cache
def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or blank for what is no letter; made once in a worker."""
    t = np.full(sys.maxunicode + 1, 32, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


def grams(raw: np.ndarray, off: np.ndarray, letters: np.ndarray, step: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers and row numbers of every n-gram, one order after another, for ``step`` bytes at a time.

    Adds to ``letters`` the letters of each row.  A row may be longer than a step:
    the characters that its next n-grams begin with are carried on.
    """
    fold, most, n_rows = _fold(), max(ORDERS), len(off) - 1
    held, held_row = np.zeros(0, np.uint32), np.zeros(0, np.int32)
    last, last_row, p = 32, -1, 0
    while p < len(raw):
        q = min(len(raw), p + step)
        while q < len(raw) and raw[q] & 0xC0 == 0x80:
            q += 1
        part = raw[p:q]
        lead = np.flatnonzero((part & 0xC0) != 0x80) + p
        row = np.repeat(np.arange(n_rows, dtype=np.int32), np.diff(np.searchsorted(lead, off)))
        c = fold[np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
        p = q
        keep = c != 32
        letters += np.bincount(row[keep], minlength=n_rows)
        # one blank after each word, and one at a row's begin
        keep |= np.append(last != 32, c[:-1] != 32) | (np.append(last_row, row[:-1]) != row)
        last, last_row = int(c[-1]), int(row[-1])
        c, row = np.concatenate([held, c[keep]]), np.concatenate([held_row, row[keep]])
        h = np.zeros(len(c), np.uint32)
        for n in range(1, most + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = (h[:m] * np.uint32(0x01000193)) ^ (c[n - 1 :] * np.uint32(0x9E3779B1))
            if n in ORDERS:
                new = row[:m] == row[n - 1 :]
                new[: max(0, len(held) - n + 1)] = False  # n-grams of the step before
                mixed = h ^ (h >> np.uint32(15))
                mixed = mixed * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF)
                yield (mixed >> np.uint32(16))[new].astype(np.int32) & (BUCKETS - 1), row[:m][new]
        held, held_row = c[len(c) - most + 1 :] if len(c) >= most else c, row[len(c) - most + 1 :] if len(c) >= most else row


def fit(docs: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their log-probability matrix with the prior as last column, from rows where ``learn`` holds."""
    rows = docs.where(named(lang).isNotNull() & named(text).isNotNull())
    rows = rows.where(learn) if learn is not None else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = {}, {}  # one vector per language, whatever the task reads
        for batch in pieces(batches):
            names, of = np.unique(np.array(batch.column(1).to_pylist(), object), return_inverse=True)
            for name, n in zip(names, np.bincount(of)):
                seen[name] = seen.get(name, 0) + int(n)
                counts.setdefault(name, np.zeros(BUCKETS, np.int64))
            for b, r in grams(*utf8(batch.column(0)), np.zeros(batch.num_rows, np.int64)):
                lang = of[r]
                for k, name in enumerate(names):
                    counts[name] += np.bincount(b[lang == k], minlength=BUCKETS)
        for name, total in counts.items():
            b = np.flatnonzero(total)
            b = b if len(b) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(b)), pa.array(b.astype(np.int32)), pa.array(total[b]), pa.array(np.where(np.arange(len(b)) == 0, seen[name], 0))], names=["lang", "bucket", "n", "docs"])

    counted = map_arrow(rows.select(named(text).cast("string").alias("text"), named(lang).cast("string").alias("lang")), run, "lang string, bucket int, n bigint, docs bigint")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # at most BUCKETS rows a language, and of languages no more than MAX_LANGS
    packed = got.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"), F.sum("docs").alias("docs")).limit(MAX_LANGS + 1).collect()
    if len(packed) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    packed.sort(key=lambda r: r.lang)
    model = np.full((len(packed), BUCKETS + 1), 0.5)
    for i, r in enumerate(packed):
        model[i, np.array(r.b, np.int64)] += np.array(r.n, np.float64)
    if len(packed):
        model[:, :BUCKETS] = np.log(model[:, :BUCKETS] / model[:, :BUCKETS].sum(axis=1, keepdims=True))
        docs_ = np.array([r.docs for r in packed], np.float64) + 1
        model[:, BUCKETS] = np.log(docs_ / docs_.sum())
    return [r.lang for r in packed], model.astype(np.float32)


def _scorer(langs: list[str], logp: np.ndarray):
    """Best language, its posterior (0 where there is no letter) and the letters of each text."""
    table = np.ascontiguousarray(logp[:, :-1])

    def score(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(off) - 1
        letters = np.zeros(n, np.int64)
        total = np.tile(logp[:, -1].astype(np.float64)[:, None], (1, n))
        for b, r in grams(raw, off, letters):
            for k in range(len(langs)):
                total[k] += np.bincount(r, weights=table[k][b], minlength=n)
        if not langs:
            return np.zeros(n, np.int64), np.zeros(n), letters
        best = total.argmax(axis=0)
        return best, np.where(letters > 0, 1 / np.exp(total - total.max(axis=0)).sum(axis=0), 0.0), letters

    return score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (posterior of the predicted language), n_letters: one row per input row."""
    box = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        langs, score = box.value[0], _scorer(*box.value)

        def work(batch: pa.RecordBatch) -> dict:
            best, posterior, letters = score(*utf8(batch.column(1)))
            names = [UND if not n or not langs else langs[k] for k, n in zip(best, letters)]
            return {"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": posterior, "n_letters": letters.astype(np.int64)}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, lang_pred string, score double, n_letters bigint", make)


def keep_known(docs: DataFrame, model: tuple[list[str], np.ndarray], least: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without rows that are ``und`` or whose best language has a posterior under ``least``; no shuffle."""
    box = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = _scorer(*box.value)

        def keep(column: pa.Array) -> np.ndarray:
            _, posterior, letters = score(*utf8(column))
            return (letters > 0) & (posterior >= least)

        return keep

    return filter_text(docs, text, make)
