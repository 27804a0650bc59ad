"""Spelling variants: words one inserted, deleted or replaced character apart, grouped under their most frequent form.

One edit leaves a half of a word intact, its beginning or its end.  So each word
is filed in a forward dictionary under its first half and in a reversed one under
its last half; the words of a block share that half.  A block of more than
``BLOCK`` words is subdivided: of what is left of its words between the intact
parts, again one half must be intact.  Blocks end when they are small, or when
what is left is so short that every pair in them is a result, so no block grows
with the dictionary.  Spark's sort-merge join sorts the dictionaries by block and
scans equal ranges; the edit distance of a pair is part of the join's condition.

Two kinds of blocks keep them narrow: for replacements, words of one length m of
which floor(m/2) characters are intact on one side; for insertions and deletions,
words of m and of m + 1 characters, of which ceil(m/2) are.  A pair is taken
where its beginning is intact, else where its end is, so none comes up twice.

Words are counted before anything is compared: a frequent word costs one row per
task.  Forms are followed to their roots by pointer doubling; each step
multiplies the count by ``ratio``, so chains are short.

Defined results: null and empty texts have no words; words are taken from whole
texts; a tie in counts goes to the word first in code-point order; repeated rows
count each; an empty table has no words; other columns may have any name and are
not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, if_small, let_go, named

MIN_CHARS, MIN_COUNT = 6, 5
#: A form is this many times as frequent as its variant.
RATIO = 5
#: Words of a block that are compared with each other.
BLOCK = 40
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, changed: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """word, n: runs of letters, A-Z lower-cased, of ``min_chars`` characters and ``min_count`` occurrences at least.

    ``changed`` makes of id and word what is counted in the word's place; it may
    shorten a word, never lengthen it.
    """
    runs = docs.select(named(key).alias("id"), F.explode(F.regexp_extract_all(named(text).cast("string"), F.lit(RUN), F.lit(0))).alias("w")).where(F.length("w") >= min_chars)
    lower = runs.select("id", F.when(F.col("w").rlike("[A-Z]"), F.translate("w", UPPER, LOWER)).otherwise(F.col("w")).alias("w"))
    words = lower.select((changed(F.col("id"), F.col("w")) if changed else F.col("w")).alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the two blocks of the next level: what lies between the intact parts gives its first or its last half to them.

    Rows: word, n, kind (replaced: S, inserted or deleted: I), longer (has m + 1
    characters), m, p and s (intact characters at the beginning and the end),
    path (sides taken so far), skips (first halves that did not agree, by level).
    """
    rest = F.col("m") - F.col("p") - F.col("s")
    half = F.when(F.col("kind") == "S", F.floor(rest / 2)).otherwise(F.ceil(rest / 2)).cast("int")
    skip = F.concat(F.length("path").cast("string"), F.lit(":"), F.substring("word", F.col("p") + 1, half))
    first = F.struct((F.col("p") + half).alias("p"), F.col("s").alias("s"), F.concat("path", F.lit("F")).alias("path"), F.col("skips").alias("skips"))
    last = F.struct(F.col("p").alias("p"), (F.col("s") + half).alias("s"), F.concat("path", F.lit("B")).alias("path"), F.array_append("skips", skip).alias("skips"))
    deeper = rows.withColumn("to", F.explode(F.array(first, last))).select("word", "n", "kind", "longer", "m", "to.*")
    begin, end = F.left("word", F.col("p")), F.reverse(F.right("word", F.col("s")))
    return deeper.withColumn("block", F.concat_ws(" ", "kind", "m", "path", begin, end))


def _filed(words: DataFrame) -> DataFrame:
    m = F.length("word")
    role = lambda kind, longer, size: F.struct(F.lit(kind).alias("kind"), F.lit(longer).alias("longer"), size.alias("m"))
    rows = words.withColumn("as", F.explode(F.array(role("S", False, m), role("I", False, m), role("I", True, m - 1))))
    return rows.select("word", "n", "as.*", F.lit(0).alias("p"), F.lit(0).alias("s"), F.lit("").alias("path"), F.array().cast("array<string>").alias("skips"))


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, na, b, nb: every pair of words exactly one edit apart, once; ``words`` holds each word once."""
    rows, found = _halves(_filed(words)), None
    while True:
        size = rows.groupBy("block", "kind").agg(F.count_if(~F.col("longer")).alias("short"), F.count_if(F.col("longer")).alias("long"), F.min(F.col("m") - F.col("p") - F.col("s")).alias("rest"))
        both = F.when(F.col("kind") == "S", F.col("short") * F.col("short")).otherwise(F.col("short") * F.col("long"))
        # with so little left, every pair of a block is near
        large = cut(size.where((both > block * block) & (F.col("rest") >= F.when(F.col("kind") == "S", 2).otherwise(1))).select("block"))
        none = large.isEmpty()
        small = rows if none else rows.join(if_small(large), "block", "left_anti")
        pairs = _compared(small)
        found = pairs if found is None else found.unionByName(pairs)
        if none:
            return found
        rows = cut(_halves(rows.join(if_small(large), "block", "left_semi").drop("block")))


def _compared(rows: DataFrame) -> DataFrame:
    """Pairs within the blocks."""
    a = rows.where(~F.col("longer")).select("block", "kind", F.col("word").alias("a"), F.col("n").alias("na"), F.col("skips").alias("sa"))
    b = rows.where(F.col("longer") | (F.col("kind") == "S")).select(F.col("block").alias("block_b"), F.col("word").alias("b"), F.col("n").alias("nb"), F.col("skips").alias("sb"))
    once = ~F.arrays_overlap("sa", "sb") & ((F.col("kind") == "I") | (F.col("a") < F.col("b")))
    return a.join(b, (F.col("block") == F.col("block_b")) & once & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb")


def group(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table of words and counts.

    The form is the near word of largest count, if that is ``ratio`` times the
    word's own; the root is where the forms lead to.
    """
    words = cut(words.select("word", "n"))
    pairs = near_pairs(words, block)
    ways = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("n")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("n")))).alias("w")).select("w.*")
    best = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("other"))).alias("top"))
    good = -F.col("top.less") >= ratio * F.col("n")
    shown = words.join(best, "word", "left").select("word", F.when(good, F.col("top.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, -F.col("top.less")).alias("form_n"))
    shown = cut(shown)
    roots = _roots(shown.where("form is not null").select("word", "form"))
    return shown.join(if_small(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: each round doubles the steps taken, until no root has a form of its own."""
    now = cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.where("moved").isEmpty():
        step = now.select(F.col("word").alias("via"), F.col("root").alias("far"))
        before, now = now, cut(now.join(if_small(step), F.col("root") == F.col("via"), "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        let_go(before)
    return now.select("word", "root")
