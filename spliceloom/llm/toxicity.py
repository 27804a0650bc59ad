"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are words and word beginnings of a fixed lexicon, patterns (shouting,
exclamation, repetition), and words and word beginnings that the labelled rows
single out.  The label model is generative: a row has a class, and every voter
fires at a rate that depends on the class and, where voters are correlated within
a class, on whether one other voter fires (a tree of dependences, so that a voter
and its near copy do not count twice).  Correlations beyond the tree lower a
voter's weight.  Rates and classes are found by expectation
maximisation with the given label as one more voter.  A logistic classifier over
the voters' firings is trained on the posterior labels; it alone scores documents.

What the models leave open is chosen by cross-validation: voters are mined and both
models fitted on all folds but one of the labelled rows, the one is scored, and the
constants with the least log-loss over all folds are taken.  Rows that are not
learned from have no part in it.

Only a bounded sample of labelled rows is learned from, however many there are: the
``SAMPLE_ROWS`` with the smallest hash of their id.  Scoring covers every row and its
whole text.

Defined results: null and empty texts get the score of a text on which no voter
fires; long texts are taken whole, and alone; repeated rows get a row each; without
any labelled row, or with an empty table, the lexicon decides with fixed rates; where
a fold's rest has but one label, the first constants of GRID serve; ids
that several label rows name count once, toxic if any says so (ties); equal texts
are learned from once; other columns of the tables are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, keyed, map_arrow, map_text, named, pieces, utf8, word_bounds, word_hash

#: Labelled rows learned from, at most.
SAMPLE_ROWS = 20_000
#: Mined voters kept, those with the strongest evidence.
MAX_VOTERS = 1_000
#: Bytes of the word beginnings that may vote.
STEMS = (4, 5, 6)
THRESHOLD = 0.7


class Constants(NamedTuple):
    """What the models leave open; ``choose`` picks one of GRID by the labels learned from."""

    #: Most that the silence of a row's other voters counts for, as a log-ratio.
    silent: float
    #: Log-ratio of a voter's rates on toxic and clean text from which it counts as strong.
    strong: float
    #: Correlation of two voters on toxic rows from which it lowers their weights.
    phi: float


GRID = [Constants(a, b, c) for a in (0.0, 1.0, 3.0) for b in (4.0, 5.0, np.inf) for c in (0.5, np.inf)]
#: Folds of the labelled rows, by crc32 of the text, and steps of a fold's classifier.
FOLDS, FOLD_STEPS = 3, 500
LEXICON = ("bastard", "clown", "creep", "crap", "disgusting", "dumb", "filth", "fool", "freak", "garbage", "hate", "idiot", "imbecile", "jerk", "loser", "maggot", "moron", "pathetic", "pig", "scum", "shut", "stupid", "trash", "vermin", "worthless")
PATTERNS = ("shouting", "exclaiming", "repeating")


def _letters() -> np.ndarray:
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def firings(raw: np.ndarray, off: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, voter hash) of all words, word beginnings and patterns of each text, each once a row."""
    low = ascii_lower()[raw]
    s, e = word_bounds(letters[low], off)
    row = np.searchsorted(off, s, side="right") - 1
    whole = word_hash(low, s, e)
    hashes, rows = [whole], [row]
    for n in STEMS:
        long = e - s >= n
        hashes.append(word_hash(low, s[long], s[long] + n) ^ np.uint64(n << 8))
        rows.append(row[long])
    n = len(off) - 1
    words = np.bincount(row, minlength=n)
    upper = np.bincount(np.searchsorted(off, np.flatnonzero((raw >= 65) & (raw <= 90)), side="right") - 1, minlength=n)
    marks = np.bincount(np.searchsorted(off, np.flatnonzero(raw == 33), side="right") - 1, minlength=n)
    again = np.zeros(len(row), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (row[1:] == row[:-1])
    echo = np.bincount(row[again], minlength=n)
    for name, fires in zip(PATTERNS, (upper > 0.3 * np.diff(off), marks > 0.2 * words, echo > 0.2 * words)):
        at = np.flatnonzero(fires & (words > 0))
        hashes.append(np.full(len(at), pattern_hash(name), np.uint64))
        rows.append(at)
    return np.concatenate(rows), np.concatenate(hashes)


def pattern_hash(name: str) -> np.uint64:
    return hash_of(f"\x00{name}")


def hash_of(word: str, stem: int = 0) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return word_hash(raw, np.array([0]), np.array([stem or len(raw)]))[0] ^ np.uint64(stem << 8)


def _pairs(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, hash) pairs."""
    o = np.lexsort((h, row))
    row, h = row[o], h[o]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def sample(docs: DataFrame, labels: DataFrame, learn: Column | None, rows: int, key: str, text: str, label: str) -> DataFrame:
    """text, toxic and fold of the labelled rows to learn from, equal texts once."""
    known = labels.where(named(label).isNotNull() & named(key).isNotNull())
    known = (known.where(learn) if learn is not None else known).groupBy(named(key).alias("__id")).agg(F.max(named(label)).cast("int").alias("toxic"))
    few = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    at = F.broadcast(few)  # ``rows`` ids at most
    got = docs.select(named(key).alias("__id"), named(text).cast("string").alias("text")).where("text is not null").join(at, "__id")
    return cut(got.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic", (F.crc32(F.col("text").cast("binary")) % FOLDS).cast("int").alias("fold")))


def mine(rows: DataFrame, most: int = MAX_VOTERS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the voters that the labels single out, and (toxic, clean) row counts as last entry of the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in pieces(batches):
            toxic = batch.column(1).to_numpy() > 0
            row, h = _pairs(*firings(*utf8(batch.column(0)), letters))
            own, at = np.unique(h, return_inverse=True)
            bad = np.bincount(at, weights=toxic[row], minlength=len(own)).astype(np.int64)
            every = np.bincount(at, minlength=len(own)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(bad), pa.array(every)], names=["h", "bad", "n"])

    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    if not total.n or not total.bad or total.bad == total.n:
        return np.zeros(0, np.uint64), np.array([total.bad or 0, (total.n or 0) - (total.bad or 0)])
    rate = total.bad / total.n
    counts = cut(map_arrow(rows.select("text", "toxic"), run, "h bigint, bad bigint, n bigint").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")))
    share = F.col("bad") / F.col("n")
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0)
    evidence = F.col("n") * (share * F.log(share / rate) + rest)
    tested = max(2, counts.count())
    # a share over even odds that chance would show for less than one voter in a hundred tables
    chosen = counts.where("bad * 2 > n").withColumn("e", evidence).where(F.col("e") > float(np.log(tested) + 1)).orderBy(F.desc("e"), "h").limit(most)
    return np.array([r.h for r in chosen.select("h").collect()], np.int64).view(np.uint64), np.array([total.bad, total.n - total.bad])


def voter_tree(row: np.ndarray, voter: np.ndarray, q: np.ndarray, j: int, strong_phi: float) -> tuple[np.ndarray, np.ndarray]:
    """For each voter the one that it depends on within a class, -1 for none; and its weight.

    That is the more frequent voter with which it has the most mutual information
    given the class, if the information pays for the two rates more (BIC).  What a
    tree cannot say, correlations with further voters, makes the weight: 1 over 1
    and the sum of a voter's correlations above ``strong_phi`` on toxic rows with others
    than the one that it depends on and those that depend on it.
    """
    n = len(q)
    every, bad = np.zeros((j, j), np.float32), np.zeros((j, j), np.float32)  # MAX_VOTERS and the fixed ones, squared
    for lo in range(0, n, 2000):
        mine = (row >= lo) & (row < lo + 2000)
        m = np.zeros((min(2000, n - lo), j), np.float32)
        m[row[mine] - lo, voter[mine]] = 1
        every += m.T @ m
        bad += (m * q[lo : lo + 2000, None].astype(np.float32)).T @ m
    gain = np.zeros((j, j))
    for both, size in ((bad, q.sum()), (every - bad, n - q.sum())):
        both = np.clip(both.astype(float), 0, size)
        one = np.diag(both)
        for x, a, b in ((both, one[:, None], one[None]), (one[:, None] - both, one[:, None], size - one[None]), (one[None] - both, size - one[:, None], one[None]), (size - one[:, None] - one[None] + both, size - one[:, None], size - one[None])):
            ok = (x > 1e-6) & (a > 1e-6) & (b > 1e-6)
            gain += np.where(ok, x * np.log(np.where(ok, x * size / np.where(ok, a * b, 1), 1)), 0)
    order = np.lexsort((np.arange(j), -np.diag(every)))
    place = np.empty(j, np.int64)
    place[order] = np.arange(j)
    gain[place[:, None] <= place[None]] = 0  # a tree: voters depend on earlier ones alone
    best = gain.argmax(axis=1) if j else np.zeros(0, np.int64)
    parent = np.where(gain[np.arange(j), best] > np.log(max(n, 2)), best, -1)
    size, rate = max(q.sum(), 1e-9), np.clip(np.diag(bad).astype(float) / max(q.sum(), 1e-9), 0, 1)
    sd = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
    phi = (bad / size - np.outer(rate, rate)) / np.outer(sd, sd)
    np.fill_diagonal(phi, 0)
    tied = np.flatnonzero(parent >= 0)
    phi[tied, parent[tied]] = phi[parent[tied], tied] = 0
    return parent, 1 / (1 + np.where(phi > strong_phi, phi, 0).sum(axis=1))


def label_model(row: np.ndarray, voter: np.ndarray, n: int, j: int, toxic: np.ndarray, c: Constants, rounds: int = 15) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posterior labels of n rows from the firings (row, voter), ordered, of j voters and the given labels.

    Returns (posterior, rate on toxic, rate on clean, voter depended on).
    """
    q = np.clip(toxic.astype(float), 0.05, 0.95)
    prior = np.log((toxic.sum() + 0.5) / (n - toxic.sum() + 0.5))  # the class balance is the given labels'
    pair = row * np.int64(j) + voter
    for turn in range(2):  # the tree again from the first posteriors
        parent, weight = voter_tree(row, voter, q, j, c.phi)
        has = parent >= 0
        up = np.where(has, parent, 0)
        at = np.minimum(np.searchsorted(pair, row * np.int64(j) + up[voter]), max(0, len(pair) - 1))
        led = has[voter] & (pair[at] == row * np.int64(j) + up[voter]) if len(pair) else np.zeros(0, bool)  # the voter depended on fires too
        for _ in range(rounds):
            fire0, fire1, quiet0, quiet1 = np.zeros(j), np.zeros(j), np.zeros(j), np.zeros(j)
            on = []
            for w, sign in ((q, 1), (1 - q, -1)):
                fired = np.bincount(voter, weights=w[row], minlength=j)
                with_up = np.bincount(voter[led], weights=w[row[led]], minlength=j)
                size, up_fired = w.sum(), np.where(has, fired[up], 0)
                r0 = (fired - with_up + 0.1) / (size - up_fired + 1)
                r1 = (with_up + 0.1) / (up_fired + 1)
                on.append((fired + 0.1) / (size + 1))
                fire0, quiet0 = fire0 + sign * np.log(r0), quiet0 + sign * np.log1p(-r0)
                fire1, quiet1 = fire1 + sign * np.log(r1), quiet1 + sign * np.log1p(-r1)
            fire0, fire1, quiet0, quiet1 = (weight * x for x in (fire0, fire1, quiet0, quiet1))
            more = np.where(has, quiet1 - quiet0, 0)
            below = np.bincount(up[has], weights=more[has], minlength=j)  # of the voters that depend on one
            own = np.where(led, quiet1[voter], quiet0[voter])
            silent = quiet0.sum() + np.bincount(row, weights=below[voter] - own, minlength=n)
            hit = (q @ toxic + 1) / (q.sum() + 2)  # how often the given label is right, by class
            miss = ((1 - q) @ toxic + 0.1) / (n - q.sum() + 1)
            z = prior + np.bincount(row, weights=np.where(led, fire1[voter], fire0[voter]), minlength=n)
            # silent voters are evidence too, but many of them abstain by design: together they count for little
            z += np.maximum(-c.silent, silent)
            z += np.where(toxic > 0, np.log(hit / miss), np.log((1 - hit) / (1 - miss)))
            new = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-4, 1 - 1e-4)
            settled = np.abs(new - q).max(initial=0) < 1e-4
            q = new
            if settled:
                break
    return q, on[0], on[1], parent


def train_linear(row: np.ndarray, voter: np.ndarray, q: np.ndarray, j: int, steps: int = 2000, rate: float = 0.2, l2: float = 1e-6) -> np.ndarray:
    """Logistic weights (bias last) over firings, on posterior labels, by Adam."""
    n = len(q)
    w, m, v = np.zeros(j + 1), np.zeros(j + 1), np.zeros(j + 1)
    for t in range(1, steps + 1):
        z = w[-1] + np.bincount(row, weights=w[voter], minlength=n)
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - q
        g = np.append(np.bincount(voter, weights=err[row], minlength=j), err.sum()) / n + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


class Firings(NamedTuple):
    """Of labelled rows, at most SAMPLE_ROWS: labels, folds, and the ordered (row, voter) pairs."""

    toxic: np.ndarray
    fold: np.ndarray
    row: np.ndarray
    voter: np.ndarray

    def of(self, keep: np.ndarray) -> Firings:
        place = np.cumsum(keep) - 1
        some = keep[self.row]
        return Firings(self.toxic[keep], self.fold[keep], place[self.row[some]], self.voter[some])


def all_voters(mined: np.ndarray) -> np.ndarray:
    """Hashes of lexicon, patterns and mined voters, sorted."""
    return np.unique(np.concatenate([np.array([hash_of(w) for w in LEXICON] + [pattern_hash(p) for p in PATTERNS], np.uint64), mined]))


def fired(known: DataFrame, voters: np.ndarray) -> Firings:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in pieces(batches):
            row, at = _fired(voters, *firings(*utf8(batch.column(0)), letters))
            count = np.bincount(row, minlength=batch.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), lists], names=["toxic", "fold", "fired"])

    # at most SAMPLE_ROWS rows of a few voter numbers each
    got = map_arrow(known.select("text", "toxic", "fold"), run, "toxic int, fold int, fired array<int>").collect()
    row = np.repeat(np.arange(len(got)), [len(r.fired) for r in got])
    return Firings(np.array([r.toxic > 0 for r in got], float), np.array([r.fold for r in got], int), row, np.array([v for r in got for v in r.fired], np.int64))


def classifier(on_bad: np.ndarray, on_good: np.ndarray, f: Firings, q: np.ndarray, c: Constants, steps: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Which voters are strong, and the weights of voters, any strong voter and bias."""
    strong = np.log(on_bad / on_good) > c.strong
    return strong, train_linear(*_with_any(f.row, f.voter, strong), q, len(on_bad) + 1, steps)


def choose(known: DataFrame, grid: list[Constants] = GRID) -> tuple[Constants, dict[Constants, float], float, float]:
    """The constants with the least log-loss on rows that the folds left out, the loss of all, and the chosen ones' recall and false alarms there."""
    found: dict[Constants, list] = {c: [] for c in grid}
    for fold in range(FOLDS):
        mined, (bad, good) = mine(known.where(F.col("fold") != fold))
        if not bad or not good:
            return grid[0], {}, 0.0, 0.0
        voters = all_voters(mined)
        every = fired(known, voters)
        rest, own = every.of(every.fold != fold), every.of(every.fold == fold)
        models: dict[tuple[float, float], tuple] = {}
        for c in grid:
            key = c.silent, c.phi  # the label model leaves strength open
            if key not in models:
                models[key] = label_model(rest.row, rest.voter, len(rest.toxic), len(voters), rest.toxic, c)
            q, on_bad, on_good, _ = models[key]
            strong, w = classifier(on_bad, on_good, rest, q, c, FOLD_STEPS)
            row, at = _with_any(own.row, own.voter, strong)
            z = w[-1] + np.bincount(row, weights=w[at], minlength=len(own.toxic))
            found[c].append((own.toxic > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30)))))
    judged = {c: tuple(np.concatenate(x) for x in zip(*parts)) for c, parts in found.items()}
    loss = {c: float(-np.mean(np.log(np.clip(np.where(t, p, 1 - p), 1e-6, 1)))) for c, (t, p) in judged.items()}
    best = min(grid, key=loss.__getitem__)  # of equal ones the first
    t, p = judged[best]
    return best, loss, float(np.mean(p[t] >= THRESHOLD)) if t.any() else 0.0, float(np.mean(p[~t] >= THRESHOLD)) if (~t).any() else 0.0


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic", grid: list[Constants] = GRID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Voter hashes (sorted), which of them are strong, and classifier weights: voters, any strong voter, bias."""
    known = sample(docs, labels, learn, rows, key, text, label)
    mined, (bad, good) = mine(known)
    voters = all_voters(mined)
    if not bad or not good:
        words = ~np.isin(voters, [pattern_hash(p) for p in PATTERNS])
        return voters, words, np.concatenate([np.where(words, 1.0, 0.0), [3.0, -2.5]])
    c, *_ = choose(known, grid)
    f = fired(known, voters)
    q, on_bad, on_good, _ = label_model(f.row, f.voter, len(f.toxic), len(voters), f.toxic, c)
    return voters, *classifier(on_bad, on_good, f, q, c)


def _with_any(row: np.ndarray, voter: np.ndarray, strong: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The firings, and one of number len(strong) for each row on which a strong voter fires."""
    some = np.unique(row[strong[voter]])
    return np.concatenate([row, some]), np.concatenate([voter, np.full(len(some), len(strong))])


def _fired(voters: np.ndarray, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(voters, h), len(voters) - 1)
    hit = voters[at] == h
    pair = np.unique(row[hit].astype(np.int64) * len(voters) + at[hit])
    return pair // len(voters), pair % len(voters)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray], threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted, n_fired: one row per input row."""
    box = docs.sparkSession.sparkContext.broadcast(model)  # MAX_VOTERS and the fixed ones at most

    def make():
        voters, strong, w = box.value
        letters = _letters()

        def work(batch: pa.RecordBatch) -> dict:
            row, at = _fired(voters, *firings(*utf8(batch.column(1)), letters))
            row, at = _with_any(row, at, strong)
            z = w[-1] + np.bincount(row, weights=w[at], minlength=batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            return {"doc_id": batch.column(0), "score": p, "predicted": (p >= threshold).astype(np.int32), "n_fired": np.bincount(row, minlength=batch.num_rows).astype(np.int64)}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, score double, predicted int, n_fired bigint", make)
