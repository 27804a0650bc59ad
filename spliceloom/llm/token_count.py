"""Token counts of texts of any length by overlapping chunks that resynchronise.

A text longer than ``CHUNK`` characters is encoded in chunks that overlap.  The
splitter of a byte-level vocabulary scans forward and keeps no state: from one of
its boundaries on, it sees only what follows.  So a position where both the left
and the right chunk have a boundary between pre-tokens is a true boundary, if the
left chunk's is not caused by its end (boundaries nearer than ``MARGIN``
characters to that end are not used; the special strings are shorter).  Left
tokens up to it and right tokens from it are then the whole text's.  If no such
position lies in the overlap, the overlap is doubled, up to the whole left chunk,
and then the left chunk is lengthened.

A shorter text is encoded as a whole.  Most of that time is the library's splitting,
so where a text has only characters that the file's splitter surely treats alike
in another implementation of its pattern, it is split by that, and the library's
model counts each distinct pre-token once; any other text goes to the library.

Defined results: null and empty texts have no tokens; special strings in a text
count as the library counts them; long texts are counted whole, by chunks; of
several common boundaries (ties) the last is used; repeated rows and null ids
return their own rows; an empty table is empty; other columns are not read.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_chars
from .common import keyed, map_text

CHUNK = 32_768
OVERLAP = 256
MARGIN = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    return t


# ---- fixed values: the byte-level splitter's pattern, and characters outside which it is left to the library
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = r"[^\t\n\r\x20-\x7e\xa1-\u017f]"
# ---- end of fixed values


class Pretokens(dict):
    """Tokens of each distinct pre-token, by the library's model; forgets all of them beyond ``most``."""

    def __init__(self, tokenizer, spec: dict, most: int = 150_000):
        super().__init__()
        self.model, self.most, self.chars = tokenizer.model, most, byte_chars()
        splitter = spec.get("pre_tokenizer") or {}
        plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        self.known = bool(plain and spec.get("normalizer") is None and spec.get("post_processor") is None and spec["model"]["type"] == "BPE")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.words, self.unusual = regex.compile(SPLIT).findall, regex.compile(UNUSUAL).search

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.model.tokenize("".join([self.chars[b] for b in word.encode()])))
        return n

    def count(self, text: str) -> int | None:
        """Tokens of a text, None if it has to go to the library."""
        if not self.known or self.unusual(text) or any(s in text for s in self.special):
            return None
        if len(self) > self.most:
            self.clear()
        return sum(map(self.__getitem__, self.words(text)))


def boundaries(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Character positions where a pre-token begins, and the number of tokens before each."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids])
    start = np.array([a for a, _ in encoding.offsets], np.int64)
    first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (words[1:] < 0))) if len(words) else np.zeros(0, np.int64)
    return start[first], first


def splice(left, left_from: int, right, right_from: int, left_to: int, margin: int = MARGIN) -> tuple[int, int, int] | None:
    """The last proven common boundary: its position in the text, left tokens before it, right tokens before it."""
    a, na = boundaries(left)
    b, nb = boundaries(right)
    a, b = a + left_from, b + right_from
    ok = a <= left_to - margin
    both, i, j = np.intersect1d(a[ok], b[b > right_from], return_indices=True)
    if not len(both):
        return None
    return int(both[-1]), int(na[ok][i[-1]]), int(nb[b > right_from][j[-1]])


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, margin: int = MARGIN) -> int:
    """Tokens of one text, by chunks."""
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    start, size, total, skip = 0, max(chunk, 2 * margin), 0, 0
    stop = min(len(text), size)
    left = encode(start, stop)
    while stop < len(text):
        wide, found = overlap, None
        while found is None:
            begin = max(start, stop - wide)
            end = min(len(text), begin + max(size, 2 * wide))
            right = encode(begin, end)
            found = splice(left, start, right, begin, stop, margin)
            # left tokens before ``skip`` belong to an earlier chunk; a boundary must lie beyond them
            if found is not None and found[1] <= skip and start + 1 < stop - wide:
                found = None
            if found is None and begin == start:
                break
            wide *= 2
        if found is None:  # no common boundary at all: one longer left chunk
            size *= 2
            stop = min(len(text), start + size)
            left = encode(start, stop)
            continue
        _, before, skipped = found
        total += before - skip
        left, start, stop, skip = right, begin, end, skipped
    return total + len(left.ids) - skip


def counts(docs: DataFrame, path: str | None = None, limit: int = 512, chunk: int = CHUNK, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per input row."""
    path = path or default_path()

    def make():
        tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            pretokens = Pretokens(tokenizer, json.load(f))

        def work(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.zeros(len(texts), np.int64)
            short = []
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    n[i] = count_long(tokenizer, t, chunk)
                elif (k := pretokens.count(t)) is not None:
                    n[i] = k
                else:
                    short.append(i)
            for lo in range(0, len(short), 64):
                at = short[lo : lo + 64]
                n[at] = [len(e) for e in tokenizer.encode_batch_fast([texts[i] for i in at], add_special_tokens=False)]
            return {"doc_id": batch.column(0), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": n}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_text(docs, keyed(docs, key, text), f"doc_id {kind}, n_bytes bigint, n_tokens bigint", make).withColumn("over_limit", F.col("n_tokens") > limit)
