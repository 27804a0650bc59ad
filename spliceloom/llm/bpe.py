"""BPE encoding with a pair occurrence index, and decoding.

A task numbers the distinct words of a chunk of texts and holds their symbols in
one flat array with links to the neighbours.  Every mergeable pair is mapped to
all its positions; ranks are applied in ascending order (a heap of the active
ones), each at all its positions at once, and the positions of the pairs that a
merge makes are added to their ranks' lists.  Words already encoded by the task
are kept in a bounded cache.

Normalisation and word splitting follow the vocabulary file (NFC, white space,
lower case; the file's pattern).  Texts of ordinary characters are split with a
regular expression; any other text is split by the library's own normaliser and
splitter, so rare characters cannot differ.  The file's special strings found in
a text become their ids, as the library does by default.

Defined results: null and empty texts have no ids and decode to empty text; of two
special strings at one place the longer counts; equal ranks do not occur, and of
overlapping occurrences of a pair (ties) the left one merges; a long text's words
are taken some at a time; repeated rows and null ids return their own rows; an
empty table is empty; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import keyed, map_text

#: Distinct words whose ids a task keeps; beyond, it forgets all of them.
CACHE_WORDS = 150_000
#: Words that are held before their ids are looked up; a text may have more.
STEP_WORDS = 300_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return [out[b] for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file with word ends, and its splitter."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        chars = byte_chars()
        self.single = np.array([vocab.get(c, -1) for c in chars], np.int64)
        self.final = np.array([vocab.get(c + end, -1) for c in chars], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.left, self.right, self.size = left, right, max(self.token) + 1
        key = left * self.size + right
        self.rank = np.argsort(key, kind="stable")
        self.key = key[self.rank]
        born = np.full(self.size, -1)
        np.maximum.at(born, self.made, np.arange(len(pairs)))
        #: a merge may use a symbol only after the merges that make it; else positions go one at a time
        self.ordered = bool((np.maximum(born[left], born[right]) < np.arange(len(pairs))).all())
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
        self.unusual = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-įı-ňŊ-ſ]").search
        self.path = path
        self._library = None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none."""
        key = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], -1)

    def split(self, text: str) -> Iterator[list[str]]:
        """The text's words in lists of STEP_WORDS at most, characters standing for bytes not yet applied; special strings come as they are."""
        if any(s in text for s in self.special):
            for part in self.cut_special(text):
                if part in self.special:
                    yield [part]
                elif part:
                    yield from self._plain(part)
        else:
            yield from self._plain(text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        if not self.unusual(text):
            if len(text) < STEP_WORDS:
                yield self.pattern.findall(text.lower())
                return
            found = self.pattern.finditer(text.lower())
            while some := [m[0] for m in itertools.islice(found, STEP_WORDS)]:
                yield some
            return
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        plain = self._library.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(byte_chars())}
        yield [bytes(back[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self._library.pre_tokenizer.pre_tokenize_str(plain)]


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the n+1 offsets of the words; no word is empty."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum(size)
    sym = v.single[raw]
    sym[end - 1] = v.final[raw[end - 1]]
    word = np.repeat(np.arange(len(words)), size)
    if (sym < 0).any():  # bytes that the vocabulary lacks are left out
        word, sym = word[sym >= 0], sym[sym >= 0]
    n = len(sym)
    # links to neighbours within the word; n stands for none and has symbol -1
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    if n:
        last = np.append(word[1:] != word[:-1], True)
        nxt[:n][last] = n
        prv[:n][np.append(True, last[:-1])] = n
    nxt[n] = prv[n] = n
    sym = np.append(sym, -1)
    lists: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def file(pos: np.ndarray) -> None:
        """Adds the pairs that start at ``pos`` to their ranks' lists."""
        r = v.ranks(sym[pos], sym[nxt[pos]])
        pos, r = pos[r >= 0], r[r >= 0]
        if not len(r):
            return
        o = np.argsort(r, kind="stable")
        pos, r = pos[o], r[o]
        at = np.flatnonzero(np.diff(r, prepend=-1))
        for k, a, b in zip(r[at].tolist(), at.tolist(), [*at[1:].tolist(), len(r)]):
            if k in lists:
                lists[k].append(pos[a:b])
            else:
                lists[k] = [pos[a:b]]
                heapq.heappush(active, k)

    file(np.arange(n))
    while active:
        k = heapq.heappop(active)
        held = lists.pop(k)
        pos = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        a, b = v.left[k], v.right[k]
        pos = pos[(sym[pos] == a) & (sym[nxt[pos]] == b)]
        if not len(pos):
            continue
        if a == b and len(pos) > 1:  # in a run like aaa every other position merges, from the left
            joined = np.append(False, nxt[pos[:-1]] == pos[1:])
            run = np.cumsum(~joined)
            place = np.arange(len(pos)) - np.flatnonzero(~joined)[run - 1]
            pos = pos[place % 2 == 0]
        if not v.ordered:  # a merge may make a pair of lower rank: only the leftmost of each word now
            first = np.append(True, word[pos[1:]] != word[pos[:-1]])
            if not first.all():
                lists[k] = [pos[~first]]
                heapq.heappush(active, k)
            pos = pos[first]
        gone = nxt[pos]
        after = nxt[gone]
        sym[pos], sym[gone] = v.made[k], -1
        nxt[pos] = after
        prv[after] = pos
        prv[n] = n
        before = prv[pos]
        file(np.unique(np.concatenate([before[before < n], pos])))
    alive = sym[:n] >= 0
    offsets = np.concatenate([[0], np.cumsum(np.bincount(word[alive], minlength=len(words)))])
    return sym[:n][alive], offsets


class _Numbers(dict):
    """Numbers of words in the order of their first sight."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class Encoder:
    """Encodes texts; keeps the ids and token strings of words it has seen.

    Texts are held as word numbers, not as words, and STEP_WORDS of them at a time;
    what is kept is let go once it exceeds ``cache_words``.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.v, self.most = Vocabulary(path), cache_words
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.ids, self.names = _Numbers(), [], []

    def _learn(self) -> None:
        """Ids and token strings of the words that are new, special strings by their table."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        plain = [w for w in fresh if w not in self.v.special]
        ids, at = encode_words([w.encode("utf-8", "surrogateescape") for w in plain], self.v) if plain else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        data, at, ids, token = ids.astype("<u4").tobytes(), at.tolist(), ids.tolist(), self.v.token
        k = 0
        for w in fresh:
            if w in self.v.special:
                self.ids.append(np.array([self.v.special[w]], "<u4").tobytes())
                self.names.append(w)
            else:
                a, b = at[k], at[k + 1]
                self.ids.append(data[4 * a : 4 * b])
                self.names.append(" ".join([token[i] for i in ids[a:b]]))
                k += 1

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and its decoded text."""
        held: list[np.ndarray | None] = []  # a list of a text's words, or None for a text's end
        size = 0
        ids: list[bytes] = []
        names: list[str] = []

        def take() -> Iterator[tuple[bytes, str]]:
            nonlocal size
            self._learn()
            for part in held:
                if part is None:
                    yield b"".join(ids), " ".join(names)
                    ids.clear(), names.clear()
                    continue
                # words without ids (bytes that the vocabulary lacks) leave no blank behind
                some = [n for n in part.tolist() if self.ids[n]]
                ids.append(b"".join([self.ids[n] for n in some]))
                names.extend([" ".join([self.names[n] for n in some])] if some else [])
            held.clear()
            size = 0
            if len(self.numbers) > self.most:
                self._forget()

        for t in texts:
            for words in self.v.split(t) if t else ():
                held.append(np.array(list(map(self.numbers.__getitem__, words)), np.int32))
                size += len(words)
                if size >= STEP_WORDS:
                    yield from take()
            held.append(None)
        yield from take()


def decode(ids: bytes, v: Vocabulary) -> str:
    """Text of little-endian 32-bit ids; the file has no decoder, so token strings are joined by blanks."""
    return " ".join(v.token[i] for i in np.frombuffer(ids, "<u4").tolist() if i in v.token)


def encoded(docs: DataFrame, path: str | None = None, with_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, and the ids (array) and decoded text if asked for."""
    path = path or default_path()

    def make():
        encoder = Encoder(path)

        def work(batch: pa.RecordBatch) -> dict:
            cols: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids)}
            for ids, text_ in encoder.encode(batch.column(1).to_pylist()):
                row = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text_.encode()).hexdigest()]
                for k, v in zip(cols, row + [np.frombuffer(ids, "<u4").astype(np.int64), text_] * with_ids):
                    cols[k].append(v)
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int64())}
            return {"doc_id": batch.column(0)} | {k: pa.array(v, types.get(k, pa.string())) for k, v in cols.items()}

        return work

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>, decoded string" * with_ids
    return map_text(docs, keyed(docs, key, text), schema, make)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
