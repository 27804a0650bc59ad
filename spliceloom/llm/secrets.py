"""Secret scans: fixed rules, and a linear-chain conditional random field beside them.

Each line is a sequence of tokens (runs of word characters, or single other
characters).  The field tags them as secret begin (B), inside (I) or outside (O).
Features are the token's shape (character kinds, length, digits, hexadecimal),
the shapes of its neighbours, the words one and two tokens to the left (hashed),
the character next to it on either side, and how much of the text is punctuation.
Weights are fitted by maximum likelihood (forward-backward in numpy) and lines
decoded by Viterbi, many lines at a time.

The field is trained on lines made from templates and random secrets, and on the
lines of a bounded sample of texts tagged by the rules: the ``SAMPLE_ROWS`` rows
with the smallest hash among those of ``SAMPLE_CHARS`` characters or fewer.  All
texts are scanned whole.

Defined results: null and empty texts have no spans; spans are in code points,
end exclusive, by start and then by kind (ties); of field spans, those that touch
a rule's span are dropped, the rules' spans always stay; a long text is handled
alone, in time that grows with its length; repeated rows and null ids return
their own rows; an empty table is empty, and the field then learns from the
templates alone; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keyed, map_text, named, utf8, word_hash

#: Texts of which the field learns, at most, and the most characters that one of them may have.
SAMPLE_ROWS, SAMPLE_CHARS = 200, 20_000
WORD_BUCKETS = 1 << 12
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is the same as a longest run that is not shorter
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
_NAMED = re.compile(rb"password|passwd|secret|token|api_?key")


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules' matches, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def maybe(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows on which a rule may match: a rule's word, AKIA, or a long run of hexadecimal digits is in them."""
    raw = np.insert(raw, off[1:-1], 0x0A)  # no rule matches a newline, so that none runs across a border of texts
    data, hits = raw.tobytes(), []
    hits += [m.start() for m in _NAMED.finditer(data.lower())]
    at = data.find(b"AKIA")
    while at >= 0:
        hits.append(at)
        at = data.find(b"AKIA", at + 4)
    low = np.zeros(256, bool)
    low[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
    edge = np.flatnonzero(np.diff(low[raw].view(np.int8), prepend=0, append=0))
    hits += edge[::2][edge[1::2] - edge[::2] >= 16].tolist()
    out = np.zeros(len(off) - 1, bool)
    out[np.searchsorted(off[:-1] + np.arange(len(out)), np.array(hits, np.int64), side="right") - 1] = True
    return out


# ---------------------------------------------------------------- tokens and features

#: Byte kinds: 0 blank, 1 newline, 2 other single character, 3.. parts of words.
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
_KIND[0x0A] = 1
_LOWER, _UPPER, _DIGIT, _MARK, _WIDE = 3, 4, 5, 6, 7
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A], _KIND[0x80:] = _LOWER, _UPPER, _DIGIT, _WIDE
_KIND[[ord(c) for c in "_+/.-"]] = _MARK
_HEX = np.zeros(256, np.int64)
_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67), *range(0x41, 0x47)]] = 1
_LENGTHS = np.array([1, 2, 4, 8, 12, 16, 20, 32, 40, 64])
SHAPES = 32 * 11 * 4 * 2


class Tokens:
    """Tokens of a chunk of texts: byte spans, row, line, shape and the rest that features need."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        kind = _KIND[raw]
        n = len(raw)
        brk = np.zeros(n + 1, bool)
        brk[off] = True
        word = kind >= 3
        single = kind == 2
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | brk[1:n]
        last[:-1] &= ~word[1:] | brk[1:n]
        self.start = np.flatnonzero(first | single)
        self.end = np.flatnonzero(last | single) + 1
        self.row = np.searchsorted(off, self.start, side="right") - 1
        line = np.cumsum((kind == 1) | brk[:n])
        self.line = line[self.start] if len(self.start) else np.zeros(0, np.int64)
        m = len(self.start)
        flags = np.zeros(m, np.int64)
        size = self.end - self.start
        if m:
            at = self.start
            # sums over [start, next start): what lies between tokens is no word character
            for bit, k in enumerate((_LOWER, _UPPER, _DIGIT, _MARK, _WIDE)):
                flags |= (np.add.reduceat((kind == k).astype(np.int32), at) > 0).astype(np.int64) << bit
            digits = np.add.reduceat((kind == _DIGIT).astype(np.int32), at)
            hexes = np.add.reduceat(_HEX[raw].astype(np.int32), at)
            share = np.minimum(3, (4 * digits) // np.maximum(size, 1))
            self.shape = ((np.searchsorted(_LENGTHS, size, side="right") * 32 + flags) * 4 + share) * 2 + ((hexes == size) & (size >= 8))
        else:
            self.shape = np.zeros(0, np.int64)
        self.single = single[self.start] if m else np.zeros(0, bool)
        self.char = np.where(self.single, raw[self.start], 0).astype(np.int64) if m else np.zeros(0, np.int64)
        low = ascii_lower()[raw]
        self.word = np.zeros(m, np.int64)
        w = np.flatnonzero(~self.single & (size <= 24))
        self.word[w] = 1 + (word_hash(low, self.start[w], self.end[w]) % np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
        rows = len(off) - 1
        marks = np.bincount(self.row[self.single], minlength=rows) if m else np.zeros(rows, np.int64)
        every = np.maximum(1, np.bincount(self.row, minlength=rows))
        self.texture = np.minimum(3, (8 * marks // every))[self.row] if m else np.zeros(0, np.int64)

    def beside(self, x: np.ndarray, by: int) -> np.ndarray:
        """x of the token ``by`` places on (negative: before) in the same line, 0 where there is none."""
        out = np.zeros(len(x), x.dtype)
        if by > 0:
            ok = self.line[by:] == self.line[:-by]
            out[:-by][ok] = x[by:][ok]
        else:
            ok = self.line[-by:] == self.line[:by]
            out[-by:][ok] = x[:by][ok]
        return out


#: Feature families and how many values each has.
FAMILIES = {"shape": SHAPES, "shape_left": SHAPES, "shape_right": SHAPES, "char": 256, "char_left": 256, "char_left2": 256, "char_right": 256, "word_left": WORD_BUCKETS, "word_left2": WORD_BUCKETS, "word_left3": WORD_BUCKETS, "texture": 4}


def features(t: Tokens) -> dict[str, np.ndarray]:
    return {
        "shape": t.shape, "shape_left": t.beside(t.shape, -1), "shape_right": t.beside(t.shape, 1),
        "char": t.char, "char_left": t.beside(t.char, -1), "char_left2": t.beside(t.char, -2), "char_right": t.beside(t.char, 1),
        "word_left": t.beside(t.word, -1), "word_left2": t.beside(t.word, -2), "word_left3": t.beside(t.word, -3), "texture": t.texture,
    }


def emissions(f: dict[str, np.ndarray], model: dict[str, np.ndarray]) -> np.ndarray:
    """Scores (tokens x B, I, O)."""
    out = np.tile(model["bias"].astype(np.float32), (len(f["shape"]), 1))
    for name in FAMILIES:
        out += model[name][f[name]]
    return out


class Lines:
    """Lines of tokens ordered by length, longest first, to step through many at once."""

    def __init__(self, line: np.ndarray):
        begin = np.flatnonzero(np.diff(line, prepend=-1))
        size = np.diff(np.append(begin, len(line)))
        order = np.argsort(-size, kind="stable")
        self.begin, self.size = begin[order], size[order]
        #: how many lines have more than j tokens
        self.live = len(size) - np.searchsorted(np.sort(size), np.arange(int(size.max()) if len(size) else 0), side="right")

    def steps(self):
        for j, k in enumerate(self.live.tolist()):
            yield j, self.begin[:k] + j


def viterbi(score: np.ndarray, move: np.ndarray, first: np.ndarray, lines: Lines) -> np.ndarray:
    """Best tags (0 B, 1 I, 2 O) of every token."""
    back = np.zeros(score.shape, np.int8)
    tag = np.full(len(score), 2, np.int8)
    best = None
    tails = []
    for j, at in lines.steps():
        if best is None:
            best = score[at] + first
        else:
            k = len(at)
            tails.append(best[k:].argmax(axis=1))
            reach = best[:k, :, None] + move[None]
            back[at] = reach.argmax(axis=1)
            best = reach.max(axis=1) + score[at]
    if best is None:
        return tag
    tails.append(best.argmax(axis=1))
    # lines end from the shortest to the longest: tails of step j belong to lines live[j]..live[j - 1]
    end = np.zeros(len(lines.begin), np.int8)
    bounds = [len(lines.begin), *lines.live[1:].tolist(), 0]
    for (hi, lo), t in zip(zip(bounds, bounds[1:]), tails):
        end[lo:hi] = t
    now = end
    for j in range(len(lines.live) - 1, -1, -1):
        k = int(lines.live[j])
        at = lines.begin[:k] + j
        tag[at] = now[:k]
        if j:
            now[:k] = back[at, now[:k]]
    return tag


def log_likelihood(score: np.ndarray, move: np.ndarray, first: np.ndarray, lines: Lines, tag: np.ndarray):
    """Log-likelihood of ``tag``, the marginals of all tokens and the expected transitions and first tags."""
    lse = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    a, b = np.zeros(score.shape), np.zeros(score.shape)
    for j, at in lines.steps():
        a[at] = score[at] + (first if j == 0 else lse(a[at - 1][:, :, None] + move[None], 1))
    for j in range(len(lines.live) - 2, -1, -1):
        at = lines.begin[: lines.live[j + 1]] + j
        b[at] = lse(move[None] + (score[at + 1] + b[at + 1])[:, None, :], 2)
    z = lse(a[lines.begin + lines.size - 1], 1)
    whole = np.zeros(len(score))
    whole[lines.begin] = z
    which = np.zeros(len(score), np.int64)
    which[lines.begin] = lines.begin
    which = np.maximum.accumulate(which)
    zs = whole[which]
    p = np.exp(a + b - zs[:, None])
    inner = np.ones(len(score), bool)
    inner[lines.begin] = False
    i = np.flatnonzero(inner)
    pair = np.exp(a[i - 1][:, :, None] + move[None] + (score[i] + b[i])[:, None, :] - zs[i][:, None, None]).sum(axis=0)
    got = score[np.arange(len(tag)), tag].sum() + first[tag[lines.begin]].sum() + move[tag[i - 1], tag[i]].sum()
    return got - z.sum(), p, pair, p[lines.begin].sum(axis=0)


# ---------------------------------------------------------------- training

_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey", "API_KEY", "access_key", "client_secret", "auth_token", "private_key", "secretKey", "DB_PASSWORD", "credentials", "bearer", "signing_key")
_PLAIN = ("the value is", "name", "version", "note", "see", "count", "id", "date", "title", "user", "host", "path", "color", "size")


def made_lines(n: int = 1500, seed: int = 11) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with secrets and their character spans, and lines that only look alike."""
    rng = random.Random(seed)
    b64, alnum = string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits
    word = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 11)))

    def secret() -> str:
        pick = rng.randrange(6)
        if pick == 0:
            return "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 40, 64))))
        if pick == 1:
            return "AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16))
        if pick == 2:
            return rng.choice(("ghp_", "sk_live_", "xoxb-", "glpat-")) + "".join(rng.choice(alnum) for _ in range(rng.randint(20, 36)))
        return "".join(rng.choice(b64 if pick == 3 else alnum) for _ in range(rng.randint(16, 44)))

    out = []
    for _ in range(n):
        head = " ".join(word() for _ in range(rng.randint(0, 6)))
        tail = " ".join(word() for _ in range(rng.randint(0, 6)))
        kind, quote = rng.randrange(10), rng.choice(("", '"', "'"))
        if kind < 5:
            pre, s = f"{head} {rng.choice(_NAMES)}{rng.choice((' = ', '=', ': ', ' '))}{quote}", secret()
            out.append((pre + s + quote + " " + tail, [(len(pre), len(pre) + len(s))]))
        elif kind == 5:
            pre, s = f"{head} Authorization: Bearer ", secret()
            out.append((pre + s + " " + tail, [(len(pre), len(pre) + len(s))]))
        else:
            value = rng.choice((word(), str(rng.randint(0, 10**rng.randint(1, 16))), f"{word()}.{word()}@{word()}.com", f"https://{word()}.com/{word()}/{word()}", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.1.2", f"{word()}-{word()}-{word()}", f"/{word()}/{word()}/{word()}.py", word().upper(), f"{word()}_{word()}", f"{rng.choice(_NAMES)} {word()}"))
            out.append((f"{head} {rng.choice(_PLAIN)}{rng.choice((' = ', '=', ': ', ' '))}{quote}{value}{quote} {tail}", []))
    return out


def train(lines: list[tuple[str, list[tuple[int, int]]]], rounds: int = 60, rate: float = 0.3, l2: float = 1e-4) -> dict[str, np.ndarray]:
    """Weights by AdaGrad on the likelihood of texts with known spans (in characters of ASCII or code points)."""
    model: dict[str, np.ndarray] = {n: np.zeros((k, 3), np.float32) for n, k in FAMILIES.items()} | {"bias": np.zeros(3), "move": np.zeros((3, 3)), "first": np.zeros(3)}
    raw, off = utf8(pa.array([t for t, _ in lines], pa.string()))
    t = Tokens(raw, off)
    tag = np.full(len(t.start), 2, np.int64)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = lead[t.start] - lead[off[t.row]] if len(t.start) else np.zeros(0, np.int64)
    marked: dict[int, list[tuple[int, int]]] = {i: s for i, (_, s) in enumerate(lines) if s}
    edges = np.searchsorted(t.row, np.arange(len(lines) + 1))
    for i, spans in marked.items():
        for a, b in spans:
            inside = [k for k in range(edges[i], edges[i + 1]) if a <= at[k] < b]
            tag[inside] = 1
            tag[inside[:1]] = 0
    # training alone cuts long lines into pieces, so that steps stay few
    place = np.arange(len(t.line))
    begin = np.maximum.accumulate(np.where(np.diff(t.line, prepend=-1) != 0, place, 0))
    seq = Lines(np.cumsum((np.diff(t.line, prepend=-1) != 0) | ((place - begin) % 64 == 0)))
    f = features(t)
    weight = {k: np.full(v.shape, 1e-6) for k, v in model.items()}
    for _ in range(rounds):
        _, p, pair, start = log_likelihood(emissions(f, model).astype(float), model["move"], model["first"], seq, tag)
        err = p.copy()
        err[np.arange(len(tag)), tag] -= 1
        inner = np.setdiff1d(np.arange(len(tag)), seq.begin)
        real, begun = np.zeros((3, 3)), np.bincount(tag[seq.begin], minlength=3)
        np.add.at(real, (tag[inner - 1], tag[inner]), 1)
        grad = {"bias": err.sum(axis=0), "move": pair - real, "first": start - begun}
        grad |= {n: np.stack([np.bincount(f[n], weights=err[:, c], minlength=k) for c in range(3)], axis=1) for n, k in FAMILIES.items()}
        for k, g in grad.items():
            g = g / len(seq.begin) + l2 * model[k]
            weight[k] += g * g
            model[k] = model[k] - rate * g / np.sqrt(weight[k])
    return {k: v.astype(np.float32) for k, v in model.items()}


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> dict[str, np.ndarray]:
    """The field's weights: a few hundred kilobytes whatever the table's size."""
    h = F.xxhash64(named(key))
    few_chars = F.length(named(text).cast("string")) <= SAMPLE_CHARS
    rows_ = docs.where(named(key).isNotNull() & few_chars)
    least = [r.h for r in rows_.select(h.alias("h")).distinct().orderBy("h").limit(rows).collect()]  # numbers alone travel
    few = rows_.where(h.isin(least)).groupBy(h.alias("h")).agg(F.min(named(text).cast("string")).alias("t")) if least else None
    got = sorted(r.t for r in few.collect()) if few is not None else []
    return train(made_lines() + [(x, [(m.start(2), m.end(2)) if k == 0 else (a, b) for a, k, b in rule_spans(x) if (m := ASSIGN.match(x, a)) or k]) for x in got])


def field_spans(raw: np.ndarray, off: np.ndarray, model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end byte (in ``raw``) of each span that the field tags."""
    t = Tokens(raw, off)
    if not len(t.start):
        return (np.zeros(0, np.int64),) * 3
    tag = viterbi(emissions(features(t), model), model["move"], model["first"], Lines(t.line))
    inside = tag < 2
    same = np.append(False, t.line[1:] == t.line[:-1])
    open_ = inside & ((tag == 0) | ~same | np.append(True, ~inside[:-1]))
    goes_on = np.append((tag[1:] == 1) & same[1:], False)
    close = inside & ~goes_on
    a, b = np.flatnonzero(open_), np.flatnonzero(close)
    return t.row[a], t.start[a], t.end[b]


def touched(a: np.ndarray, b: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of the spans a to b share a place with one of ``spans``, which come by start."""
    if not spans:
        return np.zeros(len(a), bool)
    begin = np.array([x for x, _, _ in spans])
    furthest = np.maximum.accumulate([y for _, _, y in spans])
    before = np.searchsorted(begin, b)  # spans that begin before b
    return (before > 0) & (furthest[before - 1] > a)


def scan(docs: DataFrame, model: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans: one row per input row."""
    box = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights = box.value

        def work(batch: pa.RecordBatch) -> dict:
            raw, off = utf8(batch.column(1))
            n = batch.num_rows
            row, start, end = field_spans(raw, off, weights)
            edge = np.searchsorted(row, np.arange(n + 1))
            look = maybe(raw, off) | (np.diff(edge) > 0)
            point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)])  # code points before each byte
            counts = np.zeros((4, n), np.int64)
            base_sha, spans = [_NONE] * n, [""] * n
            for i in np.flatnonzero(look).tolist():
                found = rule_spans(raw[off[i] : off[i + 1]].tobytes().decode())
                base_sha[i] = hashlib.sha256(_joined(found).encode()).hexdigest()
                a, b = (point[x[edge[i] : edge[i + 1]]] - point[off[i]] for x in (start, end))
                alone = ~touched(a, b, found)
                more = [(x, 3, y) for x, y in zip(a[alone].tolist(), b[alone].tolist())]
                every = sorted(found + more)
                for _, k, _ in every:
                    counts[k, i] += 1
                spans[i] = _joined(every)
            return {"doc_id": batch.column(0)} | {f"n_{k}": counts[j] for j, k in enumerate(KINDS)} | {"base_sha256": pa.array(base_sha), "spans": pa.array(spans, pa.string())}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_crf bigint, base_sha256 string, spans string", make, limit=4 << 20)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_NONE = hashlib.sha256(b"").hexdigest()
